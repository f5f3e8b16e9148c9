import math
import os
import statistics

import pytest
from pyspark.sql import functions as F

from tripweave.functions.geo import interpolate, lcc_inverse
from tripweave.operators import zones
from tripweave.sources.tables import read_vertices, read_zones, write_csv


@pytest.mark.parametrize(
    "x, y, lon, lat",
    [
        (984250.0, 0.0, -74.0, 40.16666666666666),
        (1000000.0, 200000.0, -73.9431850683, 40.7156164787),
    ],
)
def test_known_points(spark, x, y, lon, lat):
    df = spark.createDataFrame([(x, y)], "x double, y double")
    row = df.select(*lcc_inverse(F.col("x"), F.col("y"))).first()
    assert row[0] == pytest.approx(lon, abs=1e-9)
    assert row[1] == pytest.approx(lat, abs=1e-9)


def forward(lon, lat):
    """The projection the other way, straight from the textbook."""
    f = 1 / 298.257222101
    e = math.sqrt(2 * f - f * f)
    p1, p2, p0 = map(math.radians, (40.66666666666666, 41.03333333333333, 40.16666666666666))

    def m(p):
        return math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)

    def t(p):
        s = e * math.sin(p)
        return math.tan(math.pi / 4 - p / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    n = math.log(m(p1) / m(p2)) / math.log(t(p1) / t(p2))
    big = m(p1) / (n * t(p1) ** n)
    rho = 6378137.0 * big * t(math.radians(lat)) ** n
    rho0 = 6378137.0 * big * t(p0) ** n
    theta = n * math.radians(lon + 74)
    unit = 0.3048006096012192
    return rho * math.sin(theta) / unit + 984250, (rho0 - rho * math.cos(theta)) / unit


def test_reprojection_undoes_the_projection(spark):
    points = [(-74.3 + i * 0.05, 40.4 + j * 0.05) for i in range(13) for j in range(13)]
    rows = [(lon, lat, *forward(lon, lat)) for lon, lat in points]
    df = spark.createDataFrame(rows, "lon double, lat double, x double, y double")
    got_lon, got_lat = lcc_inverse(F.col("x"), F.col("y"))
    worst = df.select(
        F.max(F.abs(got_lon - F.col("lon"))), F.max(F.abs(got_lat - F.col("lat")))
    ).first()
    assert max(worst) < 1e-11


def outline(spark, rows):
    return spark.createDataFrame(
        rows, "shape_seq bigint, LOCATION_ID string, x double, y double"
    )


def lon_lat(spark, points):
    df = spark.createDataFrame(points, "x double, y double")
    return [tuple(r) for r in df.select(*lcc_inverse(F.col("x"), F.col("y"))).collect()]


@pytest.mark.parametrize("sizes", [{}, {"cell": 1000.0, "parts": 2}])
def test_medians_per_outline(spark, sizes):
    odd = [(990000.0, 180000.0), (991000.0, 190000.0), (999000.0, 185000.0)]
    even = [(980000.0, 100.0), (981000.0, 900.0), (981000.0, 500.0), (989000.0, 300.0)]
    rows = [(0, "7", x, y) for x, y in odd] + [(1, "7", x, y) for x, y in even]
    rows += [(2, "", 1.0, 1.0), (3, "abc", 1.0, 1.0), (4, None, 1.0, 1.0)]
    rows += [(5, "264", 985000.0, 1.0), (6, "3", 985000.0, 1.0)]
    out = zones.zone_medians(outline(spark, rows), **sizes).collect()
    assert [(r.LocationID, r.shape_seq) for r in out] == [(3, 6), (7, 0), (7, 1)]
    for row, points in zip(out[1:], (odd, even), strict=True):
        lons, lats = zip(*lon_lat(spark, points), strict=True)
        assert row.longitude == pytest.approx(statistics.median(lons), abs=1e-13)
        assert row.latitude == pytest.approx(statistics.median(lats), abs=1e-13)
    known = zones.zone_medians(outline(spark, rows), include_unknown=True, **sizes)
    assert [r.LocationID for r in known.collect()] == [3, 7, 7, 264]


def test_location_column_is_found_by_any_spelling(spark):
    for name in ("LocationID", "location_id", "LOC_ID"):
        assert zones.find_location_column(spark.createDataFrame([(1,)], f"{name} int")) == name
    with pytest.raises(ValueError, match="among: x"):
        zones.find_location_column(spark.createDataFrame([(1,)], "x int"))


def write(folder, text):
    path = os.path.join(folder, "zones.csv")
    with open(path, "w") as handle:
        handle.write(text)
    return path


def test_zone_file(spark, folder):
    path = write(
        folder,
        "LocationID,longitude,latitude\n"
        "56,-73.1,40.1\n"
        '"56", " -73.2" ,"40.2"\n'
        " 4 ,-73.5,40.5,more\n"
        "9,-73.5\n"
        "x,-73.5,40.5\n"
        "10,west,40.5\n"
        "\n"
        "12.7,-7e1,+40.\n"
        "99999999999,-73.5,40.5\n"
        "13,1e999,40.5\n",
    )
    out = read_zones(spark, path).orderBy("LocationID").collect()
    assert [tuple(r) for r in out] == [(4, -73.5, 40.5), (12, -70.0, 40.0), (56, -73.2, 40.2)]


def test_zone_file_without_rows_gives_the_built_in_zones(spark, folder):
    out = read_zones(spark, write(folder, "LocationID,longitude,latitude\n"))
    assert sorted(r.LocationID for r in out.collect()) == [100, 142, 161, 230]


@pytest.mark.parametrize("small", [True, False])
def test_lookup_keeps_every_trip_and_fills_defaults(spark, small):
    table = spark.createDataFrame(
        [(1, -73.0, 40.0)], "LocationID bigint, longitude double, latitude double"
    )
    trips = spark.createDataFrame([(i, z) for i in range(40) for z in (1, 2, None)],
                                  "id int, zone bigint")
    out = zones.with_coords(trips, table, "zone", "pu", small)
    assert out.columns == ["id", "zone", "pu_lat", "pu_lon"]
    got = {(r.zone, r.pu_lat, r.pu_lon) for r in out.collect()}
    assert out.count() == 120
    assert got == {(1, 40.0, -73.0), (2, 40.7580, -73.9855), (None, 40.7580, -73.9855)}


def test_vertices_and_report_round_trip(spark, folder):
    rows = outline(spark, [(0, "7", 990000.0, 180000.0)]).withColumnRenamed(
        "LOCATION_ID", "LocationID"
    )
    write_csv(rows, f"{folder}/vertices.csv")
    assert [tuple(r) for r in read_vertices(spark, f"{folder}/vertices.csv").collect()] == [
        (0, "7", 990000.0, 180000.0)
    ]
    lists = spark.sql("select 1 a, array('x', 'y') b")
    write_csv(lists, f"{folder}/lists")
    assert [tuple(r) for r in spark.read.option("header", True).csv(f"{folder}/lists").collect()] == [
        ("1", "x|y")
    ]


def test_interpolation_is_held_at_both_ends(spark):
    rows = [(0, 10, -5, 1.0), (0, 10, 0, 1.0), (0, 10, 5, 2.0), (0, 10, 10, 3.0),
            (0, 10, 15, 3.0), (10, 0, 5, 1.0), (5, 5, 5, 1.0)]
    df = spark.createDataFrame(rows, "t0 bigint, t1 bigint, t bigint, expected double")
    value = interpolate(F.lit(1.0), F.lit(3.0), F.col("t0"), F.col("t1"), F.col("t"))
    assert all(r[0] == r[1] for r in df.select(value, "expected").collect())
