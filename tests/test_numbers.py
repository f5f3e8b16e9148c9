import random

from pyspark.sql import functions as F

from tripweave.functions.numbers import fixed_decimals


def test_rounding_equals_fixed_text(spark):
    chance = random.Random(3)
    values = [40.7001875, 40.7533125, -73.9842625, 2.0000005, -2.0000005, 0.0, 1.5, -0.25, 1e8 / 3]
    values += [0.0000005, 0.00000025, 123456789.1234565, 3e9 + 0.5, -1e15, 1e300]
    values += [chance.uniform(-75, 75) for _ in range(5000)]
    values += [round(chance.uniform(-75, 75), 6) + 5e-7 for _ in range(5000)]
    values += [chance.uniform(1e9, 1e10) for _ in range(20_000)]
    values += [2.0**k + chance.uniform(0, 2.0**k) for k in range(28, 40) for _ in range(500)]
    values += [chance.randint(-(10**9), 10**9) / 2**7 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fixed_decimals(F.col("v"))).collect()]
    assert got == [float(f"{v:.6f}") for v in values]


def test_null_and_nan(spark):
    df = spark.sql("select cast(null as double) a, double('nan') b")
    row = df.select(fixed_decimals(F.col("a")), fixed_decimals(F.col("b"))).first()
    assert row[0] is None and row[1] != row[1]
