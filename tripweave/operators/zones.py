"""Zone coordinates: one median point per outline, and lookups by zone id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.geo import lcc_inverse
from tripweave.operators.joins import KEY_ROWS, is_small, lookup
from tripweave.operators.medians import exact_medians
from tripweave.schema import (
    DEFAULT_LATITUDE,
    DEFAULT_LONGITUDE,
    DROPOFF_ZONE,
    FALLBACK_ZONES,
    PICKUP_ZONE,
    SENTINEL_ZONES,
)

LOCATION_NAMES = ["locationid", "location_id", "loc_id"]


def find_location_column(df: DataFrame) -> str:
    for name in df.columns:
        if name.lower() in LOCATION_NAMES:
            return name
    raise ValueError(f"no location id column among: {', '.join(df.columns)}")


def zone_points(
    vertices: DataFrame, include_unknown: bool = False, sentinels: list[int] = SENTINEL_ZONES
) -> DataFrame:
    """Outline vertices as (shape_seq, LocationID, lon, lat).

    Unusable ids are left out, and so are vertices that lack a coordinate. A null
    `shape_seq` is an outline like any other.
    """
    named = usable_vertices(vertices, include_unknown, sentinels)
    lon, lat = lcc_inverse(F.col("x"), F.col("y"))
    return named.select("shape_seq", "LocationID", lon.alias("lon"), lat.alias("lat"))


def usable_vertices(vertices: DataFrame, include_unknown: bool, sentinels: list[int]) -> DataFrame:
    """Vertices with both coordinates and a usable id; told before anything is computed of them."""
    location = F.col(find_location_column(vertices)).try_cast("bigint")
    given = vertices.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    named = given.withColumn("LocationID", location).where(F.col("LocationID").isNotNull())
    if not include_unknown:
        named = named.where(~F.col("LocationID").isin(sentinels))
    return named


def zone_medians(
    vertices: DataFrame,
    include_unknown: bool = False,
    sentinels: list[int] = SENTINEL_ZONES,
    **options: float,
) -> DataFrame:
    """Exact median longitude and latitude of each outline, ordered by zone id.

    One row per outline, not per id: an id may own several outlines. `options`
    are the cell sizes of `exact_medians`.
    """
    keys = ["shape_seq", "LocationID"]
    outlines = usable_vertices(vertices, include_unknown, sentinels).select(*keys).distinct()
    points = zone_points(vertices, include_unknown, sentinels)
    names = {"lon": "longitude", "lat": "latitude"}
    medians = exact_medians(points, keys, names, is_small(outlines), **options)
    return medians.orderBy("LocationID", "shape_seq").select(
        "LocationID", "longitude", "latitude", "shape_seq"
    )


def last_per_zone(zones: DataFrame, order: list[str]) -> DataFrame:
    """The last row of each zone id along `order`, found by a combining aggregate."""
    columns = [c for c in zones.columns if c != "LocationID" and c not in order]
    latest = F.max_by(F.struct(*columns), F.struct(*order))
    return zones.groupBy("LocationID").agg(latest.alias("_row")).select("LocationID", "_row.*")


def or_fallback(zones: DataFrame) -> DataFrame:
    """The given zones, or the four built-in ones if there are none."""
    if not zones.isEmpty():
        return zones
    return zones.sparkSession.createDataFrame(
        FALLBACK_ZONES, "LocationID bigint, longitude double, latitude double"
    )


def with_coords(
    trips: DataFrame,
    zones: DataFrame,
    key: str,
    prefix: str,
    small: bool | None = None,
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """Add `<prefix>_lat` and `<prefix>_lon` of a zone; an unknown zone gets the default."""
    small = is_small(zones) if small is None else small
    found = zones.select(
        F.col("LocationID").alias("_zone"),
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
    )
    joined = lookup(trips, found, key, "_zone", small, key_rows)
    return joined.withColumns(
        {
            f"{prefix}_lat": F.coalesce("_lat", F.lit(DEFAULT_LATITUDE)),
            f"{prefix}_lon": F.coalesce("_lon", F.lit(DEFAULT_LONGITUDE)),
        }
    ).drop("_zone", "_lat", "_lon")


def locate_trips(
    trips: DataFrame,
    zones: DataFrame,
    pickup_zone: str = PICKUP_ZONE,
    dropoff_zone: str = DROPOFF_ZONE,
) -> DataFrame:
    """Add pickup (`pu_`) and drop-off (`do_`) coordinates."""
    small = is_small(zones)
    located = with_coords(trips, zones, pickup_zone, "pu", small)
    return with_coords(located, zones, dropoff_zone, "do", small)
