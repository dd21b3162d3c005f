"""Table schemas and table maintenance (§2.2 B7-B11).

One ``StructType`` per table; ``create_table_if_absent`` declares a Parquet
table from it, and the evolve helpers drop, add and backfill columns.
Parquet does not enforce ``nullable=False``; ``split_not_null`` sends rows
that break it to a reject DataFrame instead of failing a batch.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwise.functions.hashing import utf16_sha256

log = logging.getLogger(__name__)

S, D, DT, I, B = T.StringType(), T.DoubleType(), T.DateType(), T.IntegerType(), T.BinaryType()
TS = T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_INPUT_COLUMNS = ("user_trip_id", "start_time", "end_time", "start_longitude", "start_latitude",
                     "end_longitude", "end_latitude", "service_name", "route_short_name", "mode",
                     "start_stop_name", "end_stop_name")
COORD_COLUMNS = ("start_longitude", "start_latitude", "end_longitude", "end_latitude")

# raw: CSV text columns (all strings) + enrichment
RAW = _schema(*[(c, D if c in COORD_COLUMNS else S, True) for c in RAW_INPUT_COLUMNS],
              ("source_file", S, True), ("file_date", TS, True),
              ("manhattan_distance_mi", D, True), ("euclidean_distance_mi", D, True),
              ("Origin_BG", S, True), ("Dest_BG", S, True))

CLEAN = _schema(("row_hash", B, False), ("user_trip_id", S, False), ("trip_date", DT, False),
                ("start_time_utc", TS, True), ("end_time_utc", TS, True),
                ("start_longitude", D, True), ("start_latitude", D, True),
                ("end_longitude", D, True), ("end_latitude", D, True),
                ("service_name", S, True), ("route_short_name", S, True), ("mode", S, True),
                ("start_stop_name", S, True), ("end_stop_name", S, True),
                ("source_file", S, True), ("file_date_raw", S, True),
                ("manhattan_distance_mi", D, True), ("euclidean_distance_mi", D, True),
                ("Origin_BG", S, True), ("Dest_BG", S, True))

_FLOW_MEASURES = [("leg_count", I, True), ("trip_count", I, True), ("transfer_trip_count", I, True),
                  ("avg_manhattan_mi", D, True), ("avg_euclidean_mi", D, True),
                  ("mean_start_lon", D, True), ("mean_start_lat", D, True),
                  ("mean_end_lon", D, True), ("mean_end_lat", D, True), ("avg_leg_minutes", D, True)]
_HOTSPOT_MEASURES = [("transfer_events", I, True), ("transfer_trips", I, True),
                     ("mean_lon", D, True), ("mean_lat", D, True), ("avg_leg_minutes", D, True)]

FLOW_DAILY = _schema(("trip_date", DT, False), ("Origin_BG", S, False), ("Dest_BG", S, False),
                     ("service_group", S, False), ("provider_name", S, False), *_FLOW_MEASURES)
FLOW_DAILY_ROUTE = _schema(("trip_date", DT, False), ("route_short_name", S, False),
                           ("Origin_BG", S, False), ("Dest_BG", S, False), ("service_group", S, False),
                           ("provider_name", S, False), *_FLOW_MEASURES)
TRANSFER_HOTSPOTS = _schema(("trip_date", DT, False), ("hotspot_key", S, False), ("provider_name", S, False),
                            ("start_stop_name", S, True), *_HOTSPOT_MEASURES)
TRANSFER_HOTSPOTS_ROUTE = _schema(("trip_date", DT, False), ("route_short_name", S, False),
                                  ("transfer_type", S, False), ("hotspot_key", S, False),
                                  ("hotspot_hash", B, True), ("provider_name", S, False),
                                  ("start_stop_name", S, True), ("from_route_short_name", S, False),
                                  ("to_route_short_name", S, False), *_HOTSPOT_MEASURES)
TRANSFER_HOTSPOTS_ROUTEPAIR = T.StructType(
    [f for f in TRANSFER_HOTSPOTS_ROUTE.fields if f.name != "route_short_name"])
BG_SUMMARY = _schema(("trip_date", DT, False), ("Origin_BG", S, False), ("legs", I, True),
                     ("transfer_legs", I, True), ("trips", I, True), ("trips_with_transfer", I, True),
                     ("pct_trips_with_transfer", D, True), ("avg_leg_minutes", D, True))
WALK_ACCESS_EGRESS = _schema(("trip_date", DT, False), ("walk_type", S, False), ("related_service", S, False),
                             ("related_route", S, False), ("stop_key", S, False), ("stop_name", S, True),
                             ("provider_name", S, True), ("walk_leg_count", I, True), ("trip_count", I, True),
                             ("avg_walk_minutes", D, True), ("avg_walk_euclidean_mi", D, True),
                             ("avg_walk_manhattan_mi", D, True), ("mean_start_lon", D, True),
                             ("mean_start_lat", D, True), ("mean_end_lon", D, True), ("mean_end_lat", D, True))
PUBLISH_FLOWS = _schema(("oid", I, False), ("trip_date", DT, False), ("route_short_name", S, True),
                        ("Origin_BG", S, True), ("Dest_BG", S, True), ("service_group", S, True),
                        ("provider_name", S, True), ("leg_count", I, True), ("trip_count", I, True),
                        ("transfer_trip_count", I, True), ("avg_manhattan_mi", D, True),
                        ("avg_euclidean_mi", D, True), ("avg_leg_minutes", D, True),
                        ("mean_start_lon", D, True), ("mean_start_lat", D, True),
                        ("mean_end_lon", D, True), ("mean_end_lat", D, True))
PUBLISH_HOTSPOTS = _schema(("oid", I, False), ("trip_date", DT, False), ("route_short_name", S, True),
                           ("from_route_short_name", S, True), ("to_route_short_name", S, True),
                           ("transfer_type", S, True), ("hotspot_key", S, True), ("hotspot_hash", B, True),
                           ("provider_name", S, True), ("start_stop_name", S, True),
                           ("transfer_events", I, True), ("transfer_trips", I, True),
                           ("avg_leg_minutes", D, True), ("mean_lon", D, True), ("mean_lat", D, True))
PUBLISH_WALK_EGRESS = _schema(("oid", I, False), *[(f.name, f.dataType, f.nullable)
                                                   for f in WALK_ACCESS_EGRESS.fields])
STATE = _schema(("last_file_dt", S, True), ("last_run_utc", S, True))
POLYGONS = _schema(("bg_id", S, False),
                   ("ring", T.ArrayType(T.StructType([T.StructField("x", D), T.StructField("y", D)])), False))

TABLES: dict[str, T.StructType] = {
    "raw_leg_trips": RAW,
    "LegTrips_Clean": CLEAN,
    "Flow_BG_BG_Daily": FLOW_DAILY,
    "Flow_BG_BG_Daily_Route": FLOW_DAILY_ROUTE,
    "Transfer_Hotspots_Daily": TRANSFER_HOTSPOTS,
    "Transfer_Hotspots_Daily_Route": TRANSFER_HOTSPOTS_ROUTE,
    "Transfer_Hotspots_Daily_RoutePair": TRANSFER_HOTSPOTS_ROUTEPAIR,
    "BG_Summary_Daily": BG_SUMMARY,
    "Walk_AccessEgress_Daily": WALK_ACCESS_EGRESS,
    "ArcGIS_Flow_BG_BG_Daily_Route_Rolling31": PUBLISH_FLOWS,
    "ArcGIS_Transfer_Hotspots_Daily_Route_Rolling31": PUBLISH_HOTSPOTS,
    "ArcGIS_Walk_Egress_Daily_Rolling31": PUBLISH_WALK_EGRESS,
}
PARTITION_COLUMNS = {"raw_leg_trips": ("file_date",), "LegTrips_Clean": ("trip_date",),
                     **{t: ("trip_date",) for t in ("Flow_BG_BG_Daily", "Flow_BG_BG_Daily_Route",
                                                    "Transfer_Hotspots_Daily", "Transfer_Hotspots_Daily_Route",
                                                    "Transfer_Hotspots_Daily_RoutePair", "BG_Summary_Daily",
                                                    "Walk_AccessEgress_Daily")}}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def create_table_if_absent(spark: SparkSession, table: str, path: str | None = None,
                           name: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY``."""
    schema = TABLES[table]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = PARTITION_COLUMNS.get(table)
    sql = f"CREATE TABLE IF NOT EXISTS {name or table} ({cols}) USING parquet"
    if parts:
        sql += f" PARTITIONED BY ({', '.join(parts)})"
    if path:
        sql += f" LOCATION '{path}'"
    spark.sql(sql)


def drop_column_if_present(df: DataFrame, column: str) -> DataFrame:
    """Drop a deprecated column; no-op when absent."""
    return df.drop(column) if column in df.columns else df


def add_column_if_absent(df: DataFrame, column: str, data_type: T.DataType) -> DataFrame:
    """Add a null column when absent."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.lit(None).cast(data_type))


def backfill_hotspot_hash(df: DataFrame, key: str = "hotspot_key", column: str = "hotspot_hash") -> DataFrame:
    """B9 + B10: ensure ``hotspot_hash`` exists and fill it where null with the
    SHA-256 of the key's UTF-16LE bytes. Column order is kept."""
    df = add_column_if_absent(df, column, T.BinaryType())
    return df.withColumn(column, F.coalesce(F.col(column), utf16_sha256(key)))


def null_count(df: DataFrame, column: str) -> int:
    return df.filter(F.col(column).isNull()).limit(1).count()


def check_not_null(df: DataFrame, column: str) -> bool:
    """Best-effort NOT NULL check: warn, never fail."""
    if null_count(df, column):
        log.warning("could not enforce NOT NULL on %s: null values present", column)
        return False
    return True


def split_not_null(df: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """D-6: rows with a null in a NOT NULL column go to a reject DataFrame
    (with a ``reject_reason``) instead of failing the batch."""
    bad: Column | None = None
    reason: Column = F.lit(None).cast("string")
    for c in reversed(columns):
        isnull = F.col(c).isNull()
        bad = isnull if bad is None else (bad | isnull)
        reason = F.when(isnull, F.lit(f"null {c}")).otherwise(reason)
    good = df.filter(~bad)
    rejects = df.filter(bad).withColumn("reject_reason", reason)
    return good, rejects


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a stored table with its declared schema: an empty or new folder
    gives an empty DataFrame instead of a schema-inference error."""
    from legwise.session import path_exists
    schema = TABLES[table]
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
