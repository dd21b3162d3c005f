"""Test inputs derived from the driver tables (FIXTURES.md §2-4).

Each fixture is a list of SQL expressions that runs unchanged on Spark
(``selectExpr``) and on DuckDB (the oracle), so the two engines see the same
rows. The row count of every fixture grows with the driver's ``events`` table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the fixtures: the events span 2024-01-01 .. 2024-01-30.
AS_OF = "2024-02-01"
DAYS_BACK = 31
REGION_PREFIX = "48029"
TIE_BREAK = "event_id"

# legs: clean-shaped rows (one user-day is one trip).
LEGS_EXPRS = [
    "event_id",
    "CAST(user_id AS STRING) AS user_trip_id",
    "CAST(ts AS DATE) AS trip_date",
    "ts AS start_time_utc",
    "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN ts - INTERVAL '1' MINUTE "
    "WHEN event_id % 2 = 0 THEN ts + INTERVAL '7' MINUTE ELSE ts + INTERVAL '11' MINUTE END AS end_time_utc",
    "CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(-98.7 AS DOUBLE) + CAST(event_id % 400 AS DOUBLE)/1000 END AS start_longitude",
    "CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(29.2 AS DOUBLE) + CAST(event_id % 300 AS DOUBLE)/1000 END AS start_latitude",
    "CAST(-98.7 AS DOUBLE) + CAST((event_id*7) % 400 AS DOUBLE)/1000 AS end_longitude",
    "CAST(29.2 AS DOUBLE) + CAST((event_id*7) % 300 AS DOUBLE)/1000 AS end_latitude",
    "CASE WHEN event_type IN ('click','purchase') THEN 'AGENCY_FIXED_ROUTE' "
    "WHEN event_type = 'view' THEN 'AGENCY_DEMAND_RESPONSE' "
    "WHEN event_type = 'signup' THEN CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'WALKING' END "
    "ELSE CASE event_id % 4 WHEN 0 THEN 'BIKESHARE' WHEN 1 THEN 'SCOOTER_VENDOR' "
    "WHEN 2 THEN 'RIDESHARE_VENDOR' ELSE 'SOMETHING_ELSE' END END AS service_name",
    "CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN NULL "
    "ELSE CONCAT('R', CAST(event_id % 7 AS STRING)) END AS route_short_name",
    "CASE WHEN event_type IN ('click','purchase','view') THEN 'Transit' "
    "WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'walk' ELSE 'Walk' END "
    "ELSE CASE event_id % 6 WHEN 0 THEN 'bike' WHEN 1 THEN 'Scooter' WHEN 2 THEN 'rideshare' "
    "WHEN 3 THEN 'bikeshare' WHEN 4 THEN 'transit' ELSE NULL END END AS mode",
    "CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 7 = 0 THEN NULL "
    "ELSE CONCAT('STOP_', CAST(event_id % 23 AS STRING)) END AS start_stop_name",
    "CASE WHEN event_id % 6 = 0 THEN '' WHEN event_id % 8 = 0 THEN NULL "
    "ELSE CONCAT('STOP_', CAST((event_id+1) % 23 AS STRING)) END AS end_stop_name",
    "CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '48029000001' "
    "ELSE CONCAT(CASE WHEN event_id % 10 = 0 THEN '48091' ELSE '48029' END, "
    "LPAD(CAST(event_id % 9 AS STRING), 7, '0')) END AS Origin_BG",
    "CASE WHEN event_id % 41 = 0 THEN NULL "
    "ELSE CONCAT('48029', LPAD(CAST((event_id*3) % 11 AS STRING), 7, '0')) END AS Dest_BG",
    "value/10 AS manhattan_distance_mi",
    "value/14 AS euclidean_distance_mi",
]

# raw: dirty all-string rows on top of legs, shaped like the raw extract.
RAW_EXPRS = [
    "event_id",
    "CONCAT('0', user_trip_id) AS user_trip_id",
    "CASE WHEN event_id % 59 = 0 THEN 'junk' ELSE CAST(start_time_utc AS STRING) END AS start_time",
    "CAST(end_time_utc AS STRING) AS end_time",
    "CASE WHEN event_id % 43 = 0 THEN 'n/a' WHEN event_id % 47 = 0 THEN 'inf' "
    "ELSE CAST(start_longitude AS STRING) END AS start_longitude",
    "CAST(start_latitude AS STRING) AS start_latitude",
    "CAST(end_longitude AS STRING) AS end_longitude",
    "CAST(end_latitude AS STRING) AS end_latitude",
    "service_name", "route_short_name", "mode", "start_stop_name", "end_stop_name",
    "CONCAT('tapped_trip_view_legs_', CAST(trip_date AS STRING), '.csv') AS source_file",
    "CASE WHEN event_id % 53 = 0 THEN 'not-a-date' ELSE CAST(trip_date AS STRING) END AS file_date_raw",
    "CAST(manhattan_distance_mi AS STRING) AS manhattan_distance_mi",
    "CAST(euclidean_distance_mi AS STRING) AS euclidean_distance_mi",
    "Origin_BG", "Dest_BG",
]

# One trip that holds a third of all legs (a default user id on one day), with
# many equal start times and missing ones.
HOT_LEGS_EXPRS = [
    "event_id",
    "CASE WHEN event_id % 3 = 0 THEN '0' ELSE user_trip_id END AS user_trip_id",
    "CASE WHEN event_id % 3 = 0 THEN CAST('2024-01-15' AS DATE) ELSE trip_date END AS trip_date",
    "CASE WHEN event_id % 21 = 0 THEN NULL ELSE CAST(CAST(start_time_utc AS DATE) AS TIMESTAMP) END AS start_time_utc",
    *[e for e in ("end_time_utc", "start_longitude", "start_latitude", "end_longitude", "end_latitude", "service_name",
                  "route_short_name", "mode", "start_stop_name", "end_stop_name", "Origin_BG", "Dest_BG",
                  "manhattan_distance_mi", "euclidean_distance_mi")],
]

# Raw rows of which some cannot be cleaned: no id, text beyond its limit.
REJECT_EXPRS = [
    "event_id",
    "CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 73 = 0 THEN REPEAT('9', 101) ELSE user_trip_id END AS user_trip_id",
    "start_time", "end_time", "start_longitude", "start_latitude", "end_longitude", "end_latitude",
    "CASE WHEN event_id % 67 = 0 THEN REPEAT('S', 201) ELSE service_name END AS service_name",
    "CASE WHEN event_id % 71 = 0 THEN REPEAT('R', 51) WHEN event_id % 79 = 0 THEN CONCAT(REPEAT('R', 50), '  ') "
    "ELSE route_short_name END AS route_short_name",
    "mode", "start_stop_name", "end_stop_name", "source_file", "file_date_raw",
    "manhattan_distance_mi", "euclidean_distance_mi",
    "CASE WHEN event_id % 83 = 0 THEN '4802900000012' ELSE Origin_BG END AS Origin_BG", "Dest_BG",
]

# Rows as they arrive in CSV files: quotes, commas and line breaks in the stop
# names, a file's layout (``kind``), and records with a field too many.
CSV_EXPRS = [
    "event_id", "user_trip_id", "start_time", "end_time", "start_longitude", "start_latitude", "end_longitude",
    "end_latitude", "service_name", "route_short_name", "mode",
    "CASE WHEN event_id % 5 = 0 THEN CONCAT('Main \"St\", No ', CAST(event_id AS STRING)) "
    "WHEN event_id % 7 = 0 THEN CONCAT('two', CHR(10), 'lines, ', CAST(event_id AS STRING)) "
    "ELSE start_stop_name END AS start_stop_name",
    "end_stop_name",
    "CASE WHEN event_id % 101 = 0 THEN 'extra' WHEN event_id % 4 = 0 THEN 'short' WHEN event_id % 2 = 0 THEN 'turned' "
    "ELSE 'plain' END AS kind",
]

# Points of the spatial-join fixture (unfiltered coordinate formula).
GRID_POINT_EXPRS = [
    "event_id",
    "CAST(-98.7 AS DOUBLE) + CAST(event_id % 400 AS DOUBLE)/1000 AS lon",
    "CAST(29.2 AS DOUBLE) + CAST(event_id % 300 AS DOUBLE)/1000 AS lat",
    "CAST(-98.7 AS DOUBLE) + CAST((event_id*7) % 400 AS DOUBLE)/1000 AS end_lon",
    "CAST(29.2 AS DOUBLE) + CAST((event_id*7) % 300 AS DOUBLE)/1000 AS end_lat",
]

# Grid polygons: 15 x 15 squares of 0.02 degrees, edges shifted by 0.0005 so
# that no fixture point lies on an edge.
GRID_N = 15
GRID_STEP = 0.02
GRID_X0 = -98.7005
GRID_Y0 = 29.1995


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-shaped legs (the input of the refresh)."""
    return _events(spark, sf_dir).selectExpr(*LEGS_EXPRS)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw rows (the input of the clean step), all text."""
    return legs(spark, sf_dir).selectExpr(*RAW_EXPRS)


def hot_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legs(spark, sf_dir).selectExpr(*HOT_LEGS_EXPRS)


def reject_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).selectExpr(*REJECT_EXPRS)


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).selectExpr(*CSV_EXPRS)


CSV_FIELDS = ("event_id", "user_trip_id", "start_time", "end_time", "start_longitude", "start_latitude",
              "end_longitude", "end_latitude", "service_name", "route_short_name", "mode", "start_stop_name",
              "end_stop_name")
#: Columns of the files of each kind; ``short`` files lack columns, ``extra`` ones have records that are too long.
CSV_LAYOUTS = {"plain": CSV_FIELDS, "turned": tuple(reversed(CSV_FIELDS)),
               "short": tuple(c for c in CSV_FIELDS if c not in ("mode", "end_stop_name")), "extra": CSV_FIELDS}


def write_csv_landing(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The CSV rows as files of several layouts below ``folder``, and one file
    that lacks a required column. Lines are built as text, so that the files do
    not depend on a CSV writer; they are named ``*.txt``."""
    rows = csv_rows(spark, sf_dir)

    def field(c: str):
        v = F.col(c).cast("string")
        quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(v.rlike('[",\\n]'), quoted).otherwise(v), F.lit(""))

    def below_header(header: str):
        def run(batches):
            for i, batch in enumerate(batches):
                lines = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_pydict({"value": lines if i else [header, *lines]})  # a file is one task's
        return run

    for kind, columns in CSV_LAYOUTS.items():
        fields = [field(c) for c in columns] + ([F.lit("surplus")] if kind == "extra" else [])
        lines = rows.where(F.col("kind") == kind).select(F.concat_ws(",", *fields).alias("value"))
        lines.mapInArrow(below_header(",".join(columns)), "value string").write.mode("overwrite").text(f"{folder}/{kind}")
    rows.select("event_id", "user_trip_id").limit(1) \
        .select(F.concat_ws(",", "event_id", "user_trip_id").alias("value")) \
        .mapInArrow(below_header("event_id,user_trip_id"), "value string").write.mode("overwrite").text(f"{folder}/broken")


def grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(*GRID_POINT_EXPRS)


def grid_polygons(spark: SparkSession) -> DataFrame:
    """``bg_id string, ring array<struct<x,y>>`` closed squares."""
    return spark.sql(f"""
        SELECT bg_id, array(struct(x0 AS x, y0 AS y), struct(x0 + {GRID_STEP}D AS x, y0 AS y),
                            struct(x0 + {GRID_STEP}D AS x, y0 + {GRID_STEP}D AS y),
                            struct(x0 AS x, y0 + {GRID_STEP}D AS y), struct(x0 AS x, y0 AS y)) AS ring
        FROM (SELECT concat('48029', lpad(cast(ix * 100 + iy AS string), 7, '0')) AS bg_id,
                     {GRID_X0}D + ix * {GRID_STEP}D AS x0, {GRID_Y0}D + iy * {GRID_STEP}D AS y0
              FROM (SELECT k DIV {GRID_N} AS ix, k % {GRID_N} AS iy
                    FROM (SELECT explode(sequence(0, {GRID_N * GRID_N - 1})) AS k)))
    """)


# Shapes of the spatial-join fixture, one for each supplier, so that they grow with
# the data: a triangle, a square with a square hole, a slanted box, or an arrow
# head; neighbours overlap. Their places come from the supplier's number.
SHAPE_X = "(-98.7003 + 0.004 * ((s_suppkey * 37) % 97))"
SHAPE_Y = "(29.2007 + 0.003 * ((s_suppkey * 53) % 89))"
SHAPE_R = "(0.0071 + 0.0023 * (s_suppkey % 4))"
SHAPES = {0: [[(-1, -1), (1, -0.7), (0.2, 1)]],
          1: [[(-1, -1), (1, -1), (1, 1), (-1, 1)], [(-0.4, -0.4), (-0.4, 0.5), (0.5, 0.5), (0.5, -0.4)]],
          2: [[(-1, 0.1), (0.1, -1), (1, -0.1), (-0.1, 1)]],
          3: [[(-1, -1), (0, -0.3), (1, -1), (0.1, 1)]]}
SHAPE_POINT_EXPRS = [
    "event_id",
    "CAST(-98.71 + 0.41 * ((event_id * 7919) % 10007) / 10007.0 AS DOUBLE) AS lon",
    "CAST(29.19 + 0.29 * ((event_id * 104729) % 10009) / 10009.0 AS DOUBLE) AS lat",
]


def _shape_case(template: str, ring: str, array: str) -> str:
    """The shapes as one expression: an array of rings of points."""
    arms = []
    for kind, rings in SHAPES.items():
        texts = []
        for r in rings:
            places = [template.format(x=f"CAST({SHAPE_X} + {dx} * {SHAPE_R} AS DOUBLE)",
                                      y=f"CAST({SHAPE_Y} + {dy} * {SHAPE_R} AS DOUBLE)") for dx, dy in [*r, r[0]]]
            texts.append(ring.format(", ".join(places)))
        arms.append(f"WHEN s_suppkey % 4 = {kind} THEN {array.format(', '.join(texts))}")
    return "CASE " + " ".join(arms) + " END"


def shape_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bg_id string, rings array<array<struct<x,y>>>``."""
    rings = _shape_case("struct({x} AS x, {y} AS y)", "array({})", "array({})")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr(
        "concat('48', lpad(cast(s_suppkey as string), 10, '0')) AS bg_id", f"{rings} AS rings")


def shape_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(*SHAPE_POINT_EXPRS)


def shapes_sql() -> str:
    """The rings as DuckDB lists of points."""
    rings = _shape_case("{{'x': {x}, 'y': {y}}}", "[{}]", "[{}]")
    return f"SELECT concat('48', lpad(CAST(s_suppkey AS VARCHAR), 10, '0')) AS bg_id, {rings} AS rings FROM supplier"


def shape_points_sql() -> str:
    return "SELECT " + ",\n  ".join(SHAPE_POINT_EXPRS) + "\nFROM events"


# --- DuckDB text of the same fixtures (used by the oracle SQL) -------------

def legs_sql() -> str:
    return "SELECT " + ",\n  ".join(LEGS_EXPRS) + "\nFROM events"


def raw_sql() -> str:
    return "SELECT " + ",\n  ".join(RAW_EXPRS) + "\nFROM legs"


def hot_legs_sql() -> str:
    return "SELECT " + ",\n  ".join(HOT_LEGS_EXPRS) + "\nFROM plain_legs"


def reject_raw_sql() -> str:
    return "SELECT " + ",\n  ".join(REJECT_EXPRS) + "\nFROM plain_raw"


def csv_rows_sql() -> str:
    return "SELECT " + ",\n  ".join(CSV_EXPRS) + "\nFROM raw"


def grid_points_sql() -> str:
    return "SELECT " + ",\n  ".join(GRID_POINT_EXPRS) + "\nFROM events"


def grid_cells_sql() -> str:
    """Grid squares as boxes for the DuckDB box-test oracle."""
    return (f"SELECT concat('48029', lpad(CAST(ix * 100 + iy AS VARCHAR), 7, '0')) AS bg_id, "
            f"{GRID_X0} + ix * {GRID_STEP} AS x0, {GRID_Y0} + iy * {GRID_STEP} AS y0 "
            f"FROM (SELECT k // {GRID_N} AS ix, k % {GRID_N} AS iy FROM range(0, {GRID_N * GRID_N}) t(k))")
