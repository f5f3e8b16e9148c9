from datetime import date

import pytest

from tripweave.operators import counts

# Published row counts of months, with their change and its percentage.
YEAR_2009 = [
    (2009, 1, 14092413, None, None),
    (2009, 2, 13380122, -712291, -5.0544289327881575),
    (2009, 3, 14387371, 1007249, 7.527950791480076),
    (2009, 4, 14294783, -92588, -0.6435366127696351),
    (2009, 5, 14796313, 501530, 3.508482780046407),
    (2009, 6, 14184249, -612064, -4.136598083590148),
    (2009, 7, 13626103, -558146, -3.93497040273334),
    (2009, 8, 13686520, 60417, 0.443391628552936),
    (2009, 9, 13984887, 298367, 2.1800063127807467),
    (2009, 10, 15604551, 1619664, 11.581530833963827),
    (2009, 11, 14275339, -1329212, -8.51810475033854),
    (2009, 12, 14583404, 308065, 2.158022306860796),
]
SPRING_2020 = [
    (2020, 3, 3007687, None, None),
    (2020, 4, 238073, -2769614, -92.08451544326255),
    (2020, 5, 348415, 110342, 46.347968900295285),
]
TOTAL_2009 = 170896055


def table(spark, rows):
    return spark.createDataFrame(rows, "year int, month int, row_count bigint")


@pytest.mark.parametrize("published", [YEAR_2009, SPRING_2020])
def test_published_changes_are_reproduced(spark, published):
    out = counts.with_change(table(spark, [r[:3] for r in published[::-1]])).collect()
    got = [(r.year, r.month, r.row_count, r.mom_change, r.mom_change_pct) for r in out]
    assert got == published
    assert [r.date for r in out] == [date(year, month, 1) for year, month, *_ in published]


def test_published_yearly_total(spark):
    months = table(spark, [r[:3] for r in YEAR_2009])
    assert [tuple(r) for r in counts.yearly_totals(months).collect()] == [(2009, TOTAL_2009)]


def test_previous_row_is_used_across_a_gap(spark):
    out = counts.monthly_stats(table(spark, [(2020, 1, 10), (2020, 4, 15)])).collect()
    assert out[1].mom_change == 5
    assert out[1].mom_change_pct == pytest.approx(50)


def test_change_after_an_empty_month_is_null(spark):
    out = counts.with_change(table(spark, [(2020, 1, 0), (2020, 2, 15)])).collect()
    assert (out[1].mom_change, out[1].mom_change_pct) == (15, None)


def test_two_files_of_a_month_stay_two_rows(spark):
    rows = [(2020, 1, 5, "b"), (2020, 1, 3, "a"), (2020, 2, 9, "c")]
    df = spark.createDataFrame(rows, "year int, month int, row_count bigint, file string")
    out = counts.with_change(df).collect()
    assert [(r.file, r.mom_change) for r in out] == [("a", None), ("b", 2), ("c", 4)]


def test_totals_and_coverage(spark):
    df = table(spark, [(2020, 2, 5), (2019, 12, 3), (2020, 1, 4)])
    assert [tuple(r) for r in counts.yearly_totals(df).collect()] == [(2019, 3), (2020, 9)]
    assert counts.grand_total(df).first()[0] == 12
    assert tuple(counts.coverage(df).first()) == (date(2019, 12, 1), date(2020, 2, 1), 3)


def test_rows_without_a_time_are_not_counted(spark):
    df = spark.sql(
        "select * from values (timestamp_ntz'2020-01-31 23:59:59'), (timestamp_ntz'2020-02-01'),"
        " (null) as t(ts)"
    )
    out = counts.monthly_counts(df, "ts").orderBy("month").collect()
    assert [tuple(r) for r in out] == [(2020, 1, 1), (2020, 2, 1)]
