"""The same queries as SQL over the same tables, for the side-by-side check."""

from __future__ import annotations

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# --- shared pieces, one per stand-in ------------------------------------------

MONTHS = """
months AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         count(*) AS row_count
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2
)"""

CHANGES = (
    MONTHS
    + """,
changes AS (
  SELECT year, month, row_count, make_date(year, month, 1) AS date,
         row_count - lag(row_count) OVER w AS mom_change,
         (CAST(row_count AS DOUBLE) / CAST(lag(row_count) OVER w AS DOUBLE) - 1) * 100
           AS mom_change_pct
  FROM months WINDOW w AS (ORDER BY year, month)
)"""
)

ORDER_FILES = """
order_files AS (
  SELECT o_orderkey, o_totalprice,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'order_' || o_orderkey || '.parquet'
         ELSE 'trips_' || year(o_orderdate) || '-'
              || lpad(CAST(o_custkey % 16 AS VARCHAR), 2, '0') || '.parquet' END AS path
  FROM orders
),
periods AS (
  SELECT *,
    TRY_CAST(regexp_extract(path, '(\\d{4})-(0[1-9]|1[0-2])', 1) AS INTEGER) AS year,
    TRY_CAST(regexp_extract(path, '(\\d{4})-(0[1-9]|1[0-2])', 2) AS INTEGER) AS month
  FROM order_files
)"""

TRIPS = """
trips AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
         o_orderdate AS pickup, l_shipdate AS dropoff,
         CAST(NULLIF(c_nationkey, 0) AS BIGINT) AS pu, CAST(s_nationkey AS BIGINT) AS "do",
         'trips_' || strftime(l_shipdate, '%Y-%m') || '.parquet' AS name,
         coalesce(c_nationkey NOT IN (23, 24) OR c_nationkey = 0, true)
           AND coalesce(s_nationkey NOT IN (23, 24), true) AS real_zones,
         year(o_orderdate) = year(l_shipdate) AND month(o_orderdate) = month(l_shipdate)
           AS in_label,
         l_shipdate >= o_orderdate AS valid_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
)"""

TRIP_COLUMNS = 'l_orderkey, l_linenumber, l_partkey, l_extendedprice, pickup, dropoff, pu, "do", name'

LEGS = """
raw_legs AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         (CAST(round(value * 100) AS BIGINT) - 2000) * 100000 AS duration,
         epoch_us(ts) AS pickup_us
  FROM events
),
legs AS (
  SELECT event_id AS trip_id, user_id, k AS pu, k % 25 AS "do", event_type, value,
         coalesce(nullif(value / 4, CAST(12.5 AS DOUBLE)), 0) AS trip_distance,
         pickup_us, pickup_us + duration AS dropoff_us,
         CASE WHEN duration > 0 THEN (duration - 1) // 30000000 ELSE 0 END AS ticks
  FROM raw_legs
)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS zone,
         n_nationkey * CAST(0.025 AS DOUBLE) - CAST(74.3 AS DOUBLE) AS lon,
         n_regionkey * CAST(0.1 AS DOUBLE) + n_nationkey * CAST(0.01 AS DOUBLE)
           + CAST(40.5 AS DOUBLE) AS lat
  FROM nation
),
located AS (
  SELECT legs.*,
         coalesce(p.lat, CAST(40.758 AS DOUBLE)) AS pu_lat,
         coalesce(p.lon, CAST(-73.9855 AS DOUBLE)) AS pu_lon,
         coalesce(d.lat, CAST(40.758 AS DOUBLE)) AS do_lat,
         coalesce(d.lon, CAST(-73.9855 AS DOUBLE)) AS do_lon
  FROM legs LEFT JOIN zones p ON pu = p.zone LEFT JOIN zones d ON "do" = d.zone
)"""


def timeline(source: str) -> str:
    return f"""
unfolded AS (SELECT *, unnest(range(ticks + 2)) AS event_seq FROM {source}),
timeline AS (
  SELECT *,
    CASE WHEN event_seq = 0 THEN 'PICKUP' WHEN event_seq = ticks + 1 THEN 'DROPOFF'
         ELSE 'IN_TRANSIT' END AS event,
    CASE WHEN event_seq = ticks + 1 THEN dropoff_us
         ELSE pickup_us + event_seq * 30000000 END AS event_time_us
  FROM unfolded
)"""


def moving(axis: str) -> str:
    return f"""
    CASE event WHEN 'PICKUP' THEN pu_{axis} WHEN 'DROPOFF' THEN do_{axis}
      ELSE pu_{axis} + (do_{axis} - pu_{axis})
        * (CAST(event_time_us - pickup_us AS DOUBLE) / CAST(dropoff_us - pickup_us AS DOUBLE))
    END AS {axis}"""


POSITIONS = f"""{LEGS},{ZONES},{timeline("located")},
positions AS (SELECT *, {moving("lat")}, {moving("lon")} FROM timeline)"""

ISO = "strftime(make_timestamp(event_time_us), '%Y-%m-%dT%H:%M:%S.%fZ')"

EPOCHS = """
shifted AS (
  SELECT event_id, event_type, value,
         epoch_us(ts) - CAST(json_extract_string(props, '$.k') AS BIGINT) * 31536000000000 AS us
  FROM events
),
epochs AS (
  SELECT event_id, event_type,
    CASE WHEN value < 10 THEN 0
         WHEN event_type = 'view' THEN us // 1000000
         WHEN event_type = 'click' THEN us // 1000
         WHEN event_type = 'purchase' THEN us
         ELSE us * 1000 END AS raw
  FROM shifted
),
normalized AS (
  SELECT *,
    CASE WHEN raw = 0 THEN 0
         WHEN abs(raw) BETWEEN 1262304000000000 AND 1893456000000000 THEN raw
         WHEN abs(raw) < 100000000000 THEN raw * 1000000
         WHEN abs(raw) < 100000000000000 THEN raw * 1000
         WHEN abs(raw) < 100000000000000000 THEN raw
         ELSE raw // 1000 END AS normalized_us
  FROM epochs
),
checked AS (
  SELECT *, normalized_us BETWEEN 1262304000000000 AND 1893456000000000 AS in_range
  FROM normalized
)"""

VERTICES = """
points AS (
  SELECT vec_id, label, embedding, unnest(range(len(embedding) // 2)) AS point FROM embeddings
),
vertices AS (
  SELECT vec_id AS shape_seq, CAST(label AS BIGINT) AS "LocationID", point,
         CAST(embedding[point * 2 + 1] AS DOUBLE) * CAST(200000 AS DOUBLE)
           + CAST(984250 AS DOUBLE) AS x,
         CAST(embedding[point * 2 + 2] AS DOUBLE) * CAST(200000 AS DOUBLE)
           + CAST(200000 AS DOUBLE) AS y
  FROM points
),
ellipsoid AS (
  SELECT CAST(6378137 AS DOUBLE) AS a, sqrt(2 * f - f * f) AS e,
         radians(CAST(40.66666666666666 AS DOUBLE)) AS phi1,
         radians(CAST(41.03333333333333 AS DOUBLE)) AS phi2,
         radians(CAST(40.16666666666666 AS DOUBLE)) AS phi0
  FROM (SELECT 1 / CAST(298.257222101 AS DOUBLE) AS f)
),
cone AS (
  SELECT *,
    cos(phi1) / sqrt(1 - e * e * sin(phi1) * sin(phi1)) AS m1,
    cos(phi2) / sqrt(1 - e * e * sin(phi2) * sin(phi2)) AS m2,
    tan(pi() / 4 - phi1 / 2) / pow((1 - e * sin(phi1)) / (1 + e * sin(phi1)), e / 2) AS t1,
    tan(pi() / 4 - phi2 / 2) / pow((1 - e * sin(phi2)) / (1 + e * sin(phi2)), e / 2) AS t2,
    tan(pi() / 4 - phi0 / 2) / pow((1 - e * sin(phi0)) / (1 + e * sin(phi0)), e / 2) AS t0
  FROM ellipsoid
),
scaled AS (SELECT *, ln(m1 / m2) / ln(t1 / t2) AS n FROM cone),
plane AS (SELECT *, m1 / (n * pow(t1, n)) AS big_f, a * m1 / (n * pow(t1, n)) * pow(t0, n) AS rho0
          FROM scaled),
step AS (
  SELECT shape_seq, "LocationID", point, e, n,
         (x - 984250) * CAST(0.3048006096012192 AS DOUBLE) AS east,
         rho0 - y * CAST(0.3048006096012192 AS DOUBLE) AS south, a * big_f AS af
  FROM vertices CROSS JOIN plane
),
start AS (
  SELECT *, degrees(atan2(east, south) / n) - 74 AS lon,
         pow(sqrt(east * east + south * south) / af, 1 / n) AS t
  FROM step
),
l0 AS (SELECT *, pi() / 2 - 2 * atan(t) AS p0 FROM start),
l1 AS (SELECT *, pi() / 2 - 2 * atan(t * pow((1 - e * sin(p0)) / (1 + e * sin(p0)), e / 2)) AS p1 FROM l0),
l2 AS (SELECT *, pi() / 2 - 2 * atan(t * pow((1 - e * sin(p1)) / (1 + e * sin(p1)), e / 2)) AS p2 FROM l1),
l3 AS (SELECT *, pi() / 2 - 2 * atan(t * pow((1 - e * sin(p2)) / (1 + e * sin(p2)), e / 2)) AS p3 FROM l2),
l4 AS (SELECT *, pi() / 2 - 2 * atan(t * pow((1 - e * sin(p3)) / (1 + e * sin(p3)), e / 2)) AS p4 FROM l3),
lonlat AS (
  SELECT shape_seq, "LocationID", point, lon,
    degrees(pi() / 2 - 2 * atan(t * pow((1 - e * sin(p4)) / (1 + e * sin(p4)), e / 2))) AS lat
  FROM l4
)"""

WHOLE_FIELDS = ["DOLocationID", "VendorID", "passenger_count", "RatecodeID", "payment_type"]
DECIMAL_FIELDS = [
    "lat", "lon", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "Airport_fee", "total_amount", "trip_distance",
]
OTHER_FIELDS = ", ".join(
    ["'t' || k AS ts"]
    + [f'k + {i} AS "{n}"' for i, n in enumerate(WHOLE_FIELDS)]
    + [f"CAST('{i}.' || k AS DOUBLE) AS \"{n}\"" for i, n in enumerate(DECIMAL_FIELDS)]
)
OTHER_TEXT = " || ".join(
    [f"', \"{n}\": ' || (k + {i})" for i, n in enumerate(WHOLE_FIELDS)]
    + [f"', \"{n}\": {i}.' || k" for i, n in enumerate(DECIMAL_FIELDS)]
)
WIRE_FIELDS = ", ".join(f'"{n}"' for n in ["ts", *WHOLE_FIELDS, *DECIMAL_FIELDS])

MESSAGES = f"""
numbered AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
messages AS (
  SELECT event_id, ts AS sent_at, event_type AS event, CASE WHEN k = 13 THEN NULL ELSE event_id END AS trip_id,
    k AS "PULocationID", value AS fare_amount, {OTHER_FIELDS},
    CASE WHEN k = 29 THEN ''
      ELSE '{{"ts": "t' || k || '"' || {OTHER_TEXT} || ', "event": "' || event_type || '", "trip_id": '
        || CASE k WHEN 13 THEN 'null' WHEN 17 THEN '"' || event_id || '"' WHEN 19 THEN '"none"'
                  WHEN 23 THEN event_id || '.9' ELSE CAST(event_id AS VARCHAR) END
        || ', "PULocationID": ' || k || ', "unused": [1], "fare_amount": ' || value
        || CASE WHEN value < 1 THEN '' ELSE '}}' END END AS value,
    CASE WHEN k = 29 OR value < 1 THEN 'not JSON' WHEN k = 19 THEN 'wrong type: trip_id' END
      AS problem
  FROM numbered
)"""

BATCHES = (
    MESSAGES
    + """,
batches AS (
  SELECT CAST(day(sent_at) AS BIGINT) AS batch_id, count(*) AS received,
         count(*) FILTER (problem IS NULL) AS processed,
         count(*) FILTER (problem IS NOT NULL) AS failed
  FROM messages GROUP BY 1
)"""
)

SUCCESS = """{processed} * CAST(100 AS DOUBLE) / {received} AS success_pct,
  printf('%.2f%%', {processed} * CAST(100 AS DOUBLE) / {received}) AS success_rate"""

NAMES = ", ".join(f"'{t}'" for t in TABLES)
COLUMNS = f"""
columns AS (
  SELECT table_name AS label, table_name || '.parquet' AS file, column_name AS "column",
    ordinal_position AS pos,
    CASE data_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'double'
      WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp[us]'
      WHEN 'FLOAT[]' THEN 'list<element: float>' ELSE data_type END AS type
  FROM information_schema.columns WHERE table_name IN ({NAMES})
),
first_file AS (SELECT "column", type, pos FROM columns WHERE file = (SELECT min(file) FROM columns)),
pairs AS (SELECT file, "column" || ': ' || type AS pair FROM columns),
first_pairs AS (SELECT "column" || ': ' || type AS pair FROM first_file),
diff AS (
  SELECT file,
    coalesce((SELECT string_agg(b.pair, '|' ORDER BY b.pair) FROM first_pairs b
              WHERE b.pair NOT IN (SELECT pair FROM pairs p WHERE p.file = f.file)), '')
      AS missing_cols,
    coalesce((SELECT string_agg(p.pair, '|' ORDER BY p.pair) FROM pairs p
              WHERE p.file = f.file AND p.pair NOT IN (SELECT pair FROM first_pairs)), '')
      AS extra_cols
  FROM (SELECT DISTINCT file FROM columns) f
)"""

TABLE_ROWS = " UNION ALL ".join(
    f"SELECT '{t}' AS label, count(*) AS row_count FROM {t}" for t in TABLES
)

MEDIANS = f"""WITH {VERTICES},
ranked AS (
  SELECT shape_seq, "LocationID", lon, lat, count(*) OVER s AS n,
         row_number() OVER (s ORDER BY lon) AS lon_at, row_number() OVER (s ORDER BY lat) AS lat_at
  FROM lonlat WHERE "LocationID" NOT IN (8, 9) WINDOW s AS (PARTITION BY shape_seq, "LocationID")
)
SELECT "LocationID",
  round(avg(lon) FILTER (lon_at IN ((n + 1) // 2, n // 2 + 1)), 6) AS longitude,
  round(avg(lat) FILTER (lat_at IN ((n + 1) // 2, n // 2 + 1)), 6) AS latitude, shape_seq
FROM ranked GROUP BY shape_seq, "LocationID\""""

BROKEN_MEDIANS = f"""WITH {VERTICES},
usable AS (
  SELECT CASE WHEN shape_seq % 10 <> 0 THEN shape_seq END AS shape_seq, "LocationID", lon, lat FROM lonlat
  WHERE point % 7 <> 3 AND point % 5 <> 2 AND shape_seq % 11 NOT IN (1, 2) AND "LocationID" NOT IN (8, 9)
),
ranked AS (
  SELECT shape_seq, "LocationID", lon, lat, count(*) OVER s AS n,
         row_number() OVER (s ORDER BY lon) AS lon_at, row_number() OVER (s ORDER BY lat) AS lat_at
  FROM usable WINDOW s AS (PARTITION BY shape_seq, "LocationID")
)
SELECT "LocationID",
  round(avg(lon) FILTER (lon_at IN ((n + 1) // 2, n // 2 + 1)), 6) AS longitude,
  round(avg(lat) FILTER (lat_at IN ((n + 1) // 2, n // 2 + 1)), 6) AS latitude, shape_seq
FROM ranked GROUP BY shape_seq, "LocationID\""""

EVENT_IDS = """
SELECT event_id, event_type, ts,
  CAST(strftime(ts, '%y%m%d') AS BIGINT) * 1000000000 + row_number() OVER (
    PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS trip_id
FROM events"""


def when_dropoff(expression: str, name: str) -> str:
    return f"CASE WHEN event = 'DROPOFF' THEN {expression} END AS \"{name}\""


def when_pickup(expression: str, name: str) -> str:
    return f"CASE WHEN event = 'PICKUP' THEN {expression} END AS \"{name}\""


def fixed(expression: str) -> str:
    return f"CAST(printf('%.6f', {expression}) AS DOUBLE)"


NO_MONEY = "CAST(0 AS DOUBLE)"
NO_CODE = "CAST(0 AS BIGINT)"

TIMELINE = f"""WITH {LEGS},{timeline("legs")}
SELECT trip_id, event_seq, event, event_time_us FROM timeline"""

PAYLOADS = f"""WITH {POSITIONS}
SELECT CAST(trip_id AS VARCHAR) AS key, event, trip_id, {ISO} AS ts,
  {fixed("lat")} AS lat, {fixed("lon")} AS lon,
  {when_pickup("pu", "PULocationID")}, {when_dropoff('"do"', "DOLocationID")},
  {when_pickup("user_id", "VendorID")},
  {when_pickup("length(event_type)", "passenger_count")},
  {when_dropoff(NO_CODE, "RatecodeID")}, {when_dropoff(NO_CODE, "payment_type")},
  {when_dropoff(NO_MONEY, "extra")}, {when_dropoff(NO_MONEY, "mta_tax")},
  {when_dropoff(NO_MONEY, "tip_amount")}, {when_dropoff(NO_MONEY, "tolls_amount")},
  {when_dropoff(NO_MONEY, "improvement_surcharge")},
  {when_dropoff(NO_MONEY, "congestion_surcharge")}, {when_dropoff(NO_MONEY, "Airport_fee")},
  {when_dropoff(fixed("value"), "fare_amount")},
  {when_dropoff(fixed("value + CAST(2.5 AS DOUBLE)"), "total_amount")},
  {when_dropoff(fixed("trip_distance"), "trip_distance")}
FROM positions"""

CONFORMED = """
SELECT o_totalprice AS price, o_orderkey,
  CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END
    AS o_custkey,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  o_orderdate, CAST(NULL AS DOUBLE) AS surcharge
FROM orders"""

CLEAN = f"WITH {TRIPS} SELECT {TRIP_COLUMNS} FROM trips WHERE "

ORACLES: dict[str, str] = {
    "monthly_counts": f"WITH {CHANGES} SELECT * FROM changes",
    "monthly_stats": f"WITH {CHANGES} SELECT date, row_count, mom_change, mom_change_pct FROM changes",
    "yearly_totals": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS row_count
        FROM orders GROUP BY 1""",
    "grand_total": "SELECT count(o_orderdate) AS total_rows FROM orders",
    "covered_range": f"""WITH {MONTHS} SELECT min(make_date(year, month, 1)) AS first_month,
        max(make_date(year, month, 1)) AS last_month, count(*) AS n_months FROM months""",
    "list_files": f"""SELECT label || '.parquet' AS name, label, CAST(NULL AS INTEGER) AS year,
        CAST(NULL AS INTEGER) AS month, true AS has_bytes FROM ({TABLE_ROWS})""",
    "file_row_counts": f"SELECT label || '.parquet' AS name, row_count FROM ({TABLE_ROWS})",
    "period_from_name": f"WITH {ORDER_FILES} SELECT o_orderkey, path, year, month FROM periods",
    "period_range": f"""WITH {ORDER_FILES} SELECT o_orderkey, path AS name,
        year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS label FROM periods
        WHERE make_date(year, month, 1) BETWEEN DATE '1996-03-01' AND DATE '1998-11-01'""",
    "file_status": f"""WITH {ORDER_FILES} SELECT CASE
          WHEN year IS NULL OR year NOT BETWEEN 1996 AND 1999 THEN 'skipped_out_of_range'
          WHEN o_totalprice < 50000 THEN 'skipped_empty' ELSE 'processed' END AS status,
        count(*) AS n_files FROM periods GROUP BY 1""",
    "column_presence": f"""WITH {COLUMNS} SELECT "column",
        string_agg(DISTINCT type, '|' ORDER BY type) AS types_seen, count(*) AS files_with_column,
        {len(TABLES)} - count(*) AS files_missing_column,
        string_agg(label, '|' ORDER BY label) AS files_with_column_list FROM columns GROUP BY 1""",
    "schema_baseline": f'WITH {COLUMNS} SELECT "column", type FROM first_file ORDER BY pos',
    "schema_diff": f"WITH {COLUMNS} SELECT * FROM diff WHERE missing_cols <> '' OR extra_cols <> ''",
    "schema_mismatches": f"""WITH {COLUMNS} SELECT count(*) AS n_mismatches FROM diff
        WHERE missing_cols <> '' OR extra_cols <> ''""",
    "source_guard": f"""WITH {COLUMNS}, needed AS (SELECT unnest(['doc_id', 'text', 'label']) AS "column")
        SELECT file, string_agg("column", '|' ORDER BY "column") AS missing
        FROM (SELECT DISTINCT file FROM columns) f CROSS JOIN needed
        WHERE NOT EXISTS (SELECT 1 FROM columns c
                          WHERE c.file = f.file AND c."column" = needed."column")
        GROUP BY file""",
    "preview": "SELECT * FROM nation LIMIT 5",
    "conform_schema": CONFORMED,
    "read_layouts": CONFORMED,
    "clean_month_match": CLEAN + "in_label",
    "clean_sentinel": CLEAN + "real_zones",
    "clean_valid_time": CLEAN + "valid_time",
    "clean_all": CLEAN + "in_label AND real_zones AND valid_time",
    "clean_job_summary": f"""WITH {TRIPS} SELECT name, count(*) AS rows_in,
        count(*) FILTER (real_zones AND valid_time AND in_label) AS rows_kept FROM trips GROUP BY 1""",
    "epoch_normalise": f"WITH {EPOCHS} SELECT event_id, event_type, raw, normalized_us FROM normalized",
    "timestamp_range_check": f"""WITH {EPOCHS} SELECT event_type, count(*) AS n_rows,
        count(*) FILTER (in_range) AS n_in_range, count(*) FILTER (NOT in_range) AS n_out_of_range
        FROM checked GROUP BY 1""",
    "timestamp_sample": f"""WITH {EPOCHS}, firsts AS (
          SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY raw = 0, event_id) AS place
          FROM checked)
        SELECT event_type, raw, normalized_us,
          CASE WHEN normalized_us > 0
               THEN strftime(make_timestamp(normalized_us), '%Y-%m-%dT%H:%M:%SZ') ELSE 'n/a' END AS iso,
          in_range FROM firsts WHERE place = 1""",
    "trip_ids": """SELECT o_orderkey, o_orderdate,
        CAST(strftime(o_orderdate, '%y%m%d') AS BIGINT) * 1000000000 + row_number() OVER (
          PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderdate, o_orderkey) AS trip_id
        FROM orders""",
    "trip_ids_by_file": EVENT_IDS,
    "trip_ids_split": EVENT_IDS,
    "zone_file": """SELECT CAST(c_nationkey AS BIGINT) AS "LocationID", c_acctbal AS longitude,
          c_custkey + CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(0.5 AS DOUBLE) ELSE 0 END
            AS latitude
        FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
        QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) = 1""",
    "zone_last_wins": """SELECT CAST(label AS BIGINT) AS "LocationID",
          CAST(embedding[1] AS DOUBLE) AS longitude, CAST(embedding[2] AS DOUBLE) AS latitude
        FROM embeddings
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) = 1""",
    "zone_lookup_default": f"""WITH {LEGS},{ZONES}
        SELECT trip_id, pu AS "PULocationID", "do" AS "DOLocationID", pu_lat, pu_lon, do_lat, do_lon
        FROM located""",
    "zone_lookup_salted": f"""WITH {LEGS},{ZONES}
        SELECT trip_id, pu AS "PULocationID", pu_lat, pu_lon FROM located""",
    "zone_medians": MEDIANS,
    "zone_medians_split": MEDIANS,
    "reproject": f"""WITH {VERTICES}
        SELECT shape_seq, point, round(lon, 6) AS lon, round(lat, 6) AS lat FROM lonlat""",
    "typed_defaults": f"""WITH {LEGS}
        SELECT trip_id, "do" AS "DOLocationID", pu AS "PULocationID", {NO_CODE} AS "RatecodeID",
          user_id AS "VendorID", {NO_MONEY} AS congestion_surcharge, {NO_MONEY} AS extra,
          value AS fare_amount, {NO_MONEY} AS improvement_surcharge, {NO_MONEY} AS mta_tax,
          length(event_type) AS passenger_count, {NO_CODE} AS payment_type,
          '' AS store_and_fwd_flag, {NO_MONEY} AS tip_amount, {NO_MONEY} AS tolls_amount,
          value + CAST(2.5 AS DOUBLE) AS total_amount, trip_distance, {NO_MONEY} AS "Airport_fee",
          pickup_us, dropoff_us FROM legs""",
    "event_timeline": TIMELINE,
    "event_timeline_split": TIMELINE,
    "event_order": f"""WITH {LEGS},{timeline("legs")}
        SELECT trip_id, event_seq, event, event_time_us FROM timeline
        ORDER BY event_time_us, trip_id, event_seq""",
    "event_order_split": f"""WITH {LEGS},{timeline("legs")}
        SELECT trip_id, event_seq, event, event_time_us FROM timeline
        ORDER BY event_time_us, trip_id, event_seq""",
    "event_counts": f"""WITH {LEGS},{timeline("legs")}
        SELECT event, count(*) AS n_events FROM timeline GROUP BY 1
        UNION ALL SELECT 'sent', count(*) FROM timeline""",
    "first_event": f"""WITH {LEGS},{timeline("legs")}, earliest AS (
          SELECT min(event_time_us) AS event_time_us FROM timeline)
        SELECT event_time_us AS first_event_us, {ISO} AS first_event_iso FROM earliest""",
    "event_positions": f"""WITH {POSITIONS}
        SELECT trip_id, event_seq, event, event_time_us, lat, lon FROM positions""",
    "replay_schedule": f"""WITH {LEGS},{timeline("legs")}
        SELECT trip_id, event_seq, event, event_time_us, CAST(floor(
          (event_time_us - (SELECT min(event_time_us) FROM timeline)) / CAST(5 AS DOUBLE)) AS BIGINT)
          AS replay_offset_us FROM timeline""",
    "event_payloads": PAYLOADS,
    "event_messages": f"SELECT *, 21 AS n_fields FROM ({PAYLOADS})",
    "clean_to_events": f"""WITH {TRIPS}, identified AS (
          SELECT CAST(strftime(pickup, '%y%m%d') AS BIGINT) * 1000000000 + row_number() OVER (
              PARTITION BY name, CAST(pickup AS DATE) ORDER BY pickup, l_orderkey, l_linenumber,
              l_partkey, l_extendedprice, dropoff) AS trip_id,
            epoch_us(pickup) AS pickup_us, epoch_us(dropoff) AS dropoff_us
          FROM trips WHERE in_label AND real_zones AND valid_time),
        counted AS (SELECT *, CASE WHEN dropoff_us > pickup_us
            THEN (dropoff_us - pickup_us - 1) // 86400000000 ELSE 0 END AS ticks FROM identified),
        unfolded AS (SELECT *, unnest(range(ticks + 2)) AS event_seq FROM counted)
        SELECT trip_id, event_seq, CASE WHEN event_seq = 0 THEN 'PICKUP'
            WHEN event_seq = ticks + 1 THEN 'DROPOFF' ELSE 'IN_TRANSIT' END AS event,
          CASE WHEN event_seq = ticks + 1 THEN dropoff_us
            ELSE pickup_us + event_seq * 86400000000 END AS event_time_us FROM unfolded""",
    "decode_events": f"""WITH {MESSAGES} SELECT event_id, event, trip_id, "PULocationID", fare_amount,
        {WIRE_FIELDS} FROM messages WHERE problem IS NULL""",
    "dead_letters": f"WITH {MESSAGES} SELECT value, problem FROM messages WHERE problem IS NOT NULL",
    "feed_metrics": f"""WITH {BATCHES}, totals AS (
          SELECT CAST(sum(received) AS BIGINT) AS received, CAST(sum(processed) AS BIGINT) AS processed,
                 CAST(sum(failed) AS BIGINT) AS failed, count(*) AS batches FROM batches)
        SELECT *, {SUCCESS.format(processed="processed", received="received")} FROM totals""",
    "feed_history": f"""WITH {BATCHES}, history AS (
          SELECT *, CAST(sum(received) OVER w AS BIGINT) AS total_received,
                 CAST(sum(processed) OVER w AS BIGINT) AS total_processed,
                 CAST(sum(failed) OVER w AS BIGINT) AS total_failed
          FROM batches WINDOW w AS (ORDER BY batch_id))
        SELECT *, {SUCCESS.format(processed="total_processed", received="total_received")}
        FROM history""",
    "feed_stream": f"""WITH {MESSAGES}
        SELECT coalesce(CAST(trip_id AS VARCHAR), 'null') AS key, event, trip_id, "PULocationID",
          fare_amount, {WIRE_FIELDS} FROM messages WHERE problem IS NULL""",
    "feed_stream_metrics": f"""WITH {MESSAGES}, totals AS (
          SELECT count(*) AS received, count(*) FILTER (problem IS NULL) AS processed,
                 count(*) FILTER (problem IS NOT NULL) AS failed, 1 AS batches FROM messages)
        SELECT *, {SUCCESS.format(processed="processed", received="received")} FROM totals""",
    "ingested_rows": f"""WITH {COLUMNS}, sizes AS ({TABLE_ROWS}), needed AS (
          SELECT unnest(['doc_id', 'text']) AS "column"),
        lacking AS (
          SELECT label, coalesce((SELECT string_agg(n."column", '|' ORDER BY n."column") FROM needed n
            WHERE n."column" NOT IN (SELECT c."column" FROM columns c WHERE c.label = s.label)), '') AS missing
          FROM sizes s)
        SELECT label || '.parquet' AS file, row_count AS n_rows, missing,
          CASE WHEN label = 'documents' THEN row_count ELSE 0 END AS n_ingested,
          CASE WHEN label = 'documents' THEN 0 ELSE row_count END AS n_lost
        FROM sizes JOIN lacking USING (label)""",
    "month_folders": f"""WITH {TRIPS}
        SELECT CAST(year(dropoff) AS INTEGER) AS year, CAST(month(dropoff) AS INTEGER) AS month,
          count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM trips GROUP BY 1, 2""",
    "sequence_limit": """WITH numbered AS (SELECT event_id, row_number() OVER (
            PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS seq FROM events)
        SELECT event_id, seq, seq > 100 AS over_limit FROM numbered""",
    "fallback_zones": """SELECT CAST(column0 AS BIGINT) AS "LocationID", CAST(column1 AS DOUBLE) AS longitude,
          CAST(column2 AS DOUBLE) AS latitude
        FROM (VALUES (142, -73.9841, 40.7711), (230, -73.9860, 40.7629), (100, -73.9934, 40.7505),
                     (161, -73.9864, 40.7559)) AS z(column0, column1, column2)
        WHERE EXISTS (SELECT 1 FROM customer)""",
    "vertices_csv": f"""WITH {VERTICES} SELECT shape_seq, CAST("LocationID" AS VARCHAR) AS location_id,
          round(x, 3) AS x, round(y, 3) AS y FROM vertices""",
    "zone_lookup_hot": f"""WITH {LEGS},{ZONES}
        SELECT trip_id, pu AS "PULocationID", pu_lat, pu_lon FROM located""",
    "zone_medians_nulls": BROKEN_MEDIANS,
    "zone_medians_nulls_split": BROKEN_MEDIANS,
}
