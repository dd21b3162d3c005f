"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of SURVEY §7.3, each over whole driver tables.

Doubles are rounded to 6 places in these outputs (and in the oracle SQL) so
that the two engines' last-bit differences in sums do not matter; binary
hashes are shown as lower-case hex.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwise.functions import geo as GEO
from legwise.operators import aggregates as G
from legwise.operators import clean as CL
from legwise.operators import spatial as SP
from legwise.operators import upsert as UP
from legwise.operators import flags as FL
from legwise.operators import publish as P
from legwise.operators import validate as V
from legwise.schemas import COORD_COLUMNS, backfill_hotspot_hash, drop_column_if_present
from legwise.plans.refresh import read_refreshed, run_refresh
from legwise.session import ensure_session, scratch_path, written
from legwise.sources import csv_legs as CSV
from legwise.sources import files as SF
from legwise.sources import fixtures as FX
from legwise.sources import links as LK

ROUND = 6


def presentable(df: DataFrame) -> DataFrame:
    """Round doubles, hex binaries (for the cross-engine comparison)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.round(F.col(f.name), ROUND).alias(f.name))
        elif isinstance(f.dataType, T.BinaryType):
            cols.append(F.lower(F.hex(F.col(f.name))).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session(spark)
    return FX.legs(spark, sf_dir)


def _flags(spark, sf_dir, region_prefix=None) -> DataFrame:
    return FL.flags(_legs(spark, sf_dir), FX.AS_OF, FX.DAYS_BACK, region_prefix, tie_break=FX.TIE_BREAK)


SEQ_COLUMNS = ("leg_seq", *FL.LAGS, *FL.LEADS)


def q_leg_base(spark, sf_dir):
    return presentable(FL.base_legs(_legs(spark, sf_dir), FX.AS_OF, FX.DAYS_BACK, keep=("event_id",)))


def q_leg_sequence(spark, sf_dir):
    f = _flags(spark, sf_dir)
    return f.select("event_id", "user_trip_id", "trip_date", *SEQ_COLUMNS)


def q_transfer_flags(spark, sf_dir):
    f = _flags(spark, sf_dir)
    return f.select("event_id", "user_trip_id", "trip_date", "leg_seq", *FL.FLAG_COLUMNS)


def q_region_filtered_flags(spark, sf_dir):
    f = _flags(spark, sf_dir, FX.REGION_PREFIX)
    return f.select("event_id", "user_trip_id", "trip_date", "Origin_BG", "Dest_BG", "leg_seq",
                    *FL.FLAG_COLUMNS)


def q_flow_daily(spark, sf_dir):
    return presentable(G.flow_daily(_flags(spark, sf_dir)))


def q_flow_daily_route(spark, sf_dir):
    return presentable(G.flow_daily_route(_flags(spark, sf_dir)))


def q_transfer_hotspots(spark, sf_dir):
    return presentable(G.transfer_hotspots(_flags(spark, sf_dir)))


def q_transfer_hotspots_route(spark, sf_dir):
    return presentable(G.transfer_hotspots_route(_flags(spark, sf_dir)))


def q_transfer_hotspots_routepair(spark, sf_dir):
    return presentable(G.transfer_hotspots_routepair(G.transfer_hotspots_route(_flags(spark, sf_dir))))


def q_bg_summary(spark, sf_dir):
    return presentable(G.bg_summary(_flags(spark, sf_dir)))


def q_walk_access(spark, sf_dir):
    return presentable(G.walk_access_egress(_flags(spark, sf_dir), ("ACCESS",)))


def q_walk_egress(spark, sf_dir):
    return presentable(G.walk_access_egress(_flags(spark, sf_dir), ("EGRESS",)))


def q_walk_access_egress(spark, sf_dir):
    return presentable(G.walk_access_egress(_flags(spark, sf_dir)))


def _publish_flows(spark, sf_dir):
    return P.publish_flows(G.flow_daily_route(_flags(spark, sf_dir)), FX.AS_OF, FX.DAYS_BACK)


def _publish_hotspots(spark, sf_dir):
    return P.publish_hotspots(G.transfer_hotspots_route(_flags(spark, sf_dir)), FX.AS_OF, FX.DAYS_BACK)


def _publish_walk(spark, sf_dir):
    return P.publish_walk_egress(G.walk_access_egress(_flags(spark, sf_dir)), FX.AS_OF, FX.DAYS_BACK)


def q_publish_flows(spark, sf_dir):
    return presentable(_publish_flows(spark, sf_dir))


def q_publish_hotspots(spark, sf_dir):
    return presentable(_publish_hotspots(spark, sf_dir))


def q_publish_walk_egress(spark, sf_dir):
    return presentable(_publish_walk(spark, sf_dir))


def q_flow_lines(spark, sf_dir):
    return P.flow_lines(_publish_flows(spark, sf_dir)).select("oid", "trip_date", "wkt", "srid")


def q_hotspot_points(spark, sf_dir):
    return P.hotspot_points(_publish_hotspots(spark, sf_dir)).select("oid", "trip_date", "wkt", "srid")


def q_walk_egress_lines(spark, sf_dir):
    return P.walk_egress_lines(_publish_walk(spark, sf_dir)).select("oid", "trip_date", "wkt", "srid")


def q_hotspot_hash_backfill(spark, sf_dir):
    """B8-B10 on a route-pair table written before the hash column existed:
    drop a deprecated column, add the hash column, backfill where null."""
    old = G.transfer_hotspots_routepair(G.transfer_hotspots_route(_flags(spark, sf_dir)))
    old = old.drop("hotspot_hash").withColumn("service_name", F.lit(None).cast("string"))
    fixed = backfill_hotspot_hash(drop_column_if_present(old, "service_name"))
    return presentable(fixed.select("trip_date", "transfer_type", "hotspot_key", "hotspot_hash",
                                    "provider_name", "start_stop_name", "from_route_short_name",
                                    "to_route_short_name", "transfer_events"))


def q_validate_flows(spark, sf_dir):
    return V.date_range_count(P.flow_rows(G.flow_daily_route(_flags(spark, sf_dir)), FX.AS_OF, FX.DAYS_BACK))


def q_validate_hotspots(spark, sf_dir):
    return V.row_count(P.hotspot_rows(G.transfer_hotspots_route(_flags(spark, sf_dir)), FX.AS_OF, FX.DAYS_BACK))


def q_validate_walk_top10(spark, sf_dir):
    return presentable(V.latest_rows(_publish_walk(spark, sf_dir), 10))


# --- clean, incremental, files, links, geo ---------------------------------

FILE_SUBSTRING = "tapped_trip_view_legs"
FILE_SUFFIX = ".csv"
BATCH1_LAST_DAY = "2024-01-20"    # first incremental batch: files up to this day
BATCH2_FIRST_DAY = "2024-01-16"   # second batch re-reads 5 overlapping days
ONLY_YEARS = (2024,)


def _raw(spark, sf_dir) -> DataFrame:
    ensure_session(spark)
    return FX.raw(spark, sf_dir)


def _with_file_date(raw: DataFrame) -> DataFrame:
    return raw.withColumn("file_date", SF.file_date_from_name("source_file", FILE_SUBSTRING, FILE_SUFFIX))


def q_clean_legs(spark, sf_dir):
    c = CL.clean_transform(_raw(spark, sf_dir), keep=("event_id",))
    return presentable(c.drop("row_hash"))


def q_row_hash(spark, sf_dir):
    c = CL.clean_transform(_raw(spark, sf_dir), keep=("event_id",))
    return presentable(c.select("event_id", "trip_date", "row_hash"))


def q_incremental_upsert(spark, sf_dir):
    """Two overlapping batches (by file date) merged insert-only; equals one
    run over everything."""
    raw = _with_file_date(_raw(spark, sf_dir))
    b1 = raw.filter(F.col("file_date") <= F.lit(BATCH1_LAST_DAY).cast("timestamp_ntz"))
    b2 = raw.filter(F.col("file_date") >= F.lit(BATCH2_FIRST_DAY).cast("timestamp_ntz"))
    cols = ("event_id",)
    stored, _ = written(UP.new_rows(CL.clean_transform(b1.drop("file_date"), keep=cols), None), "upsert-stored")
    added = UP.new_rows(CL.clean_transform(b2.drop("file_date"), keep=cols), stored)
    return presentable(stored.unionByName(added).select("event_id", "trip_date", "row_hash", "source_file"))


def q_incremental_since(spark, sf_dir):
    """G10 -> T3 -> A6/F4: watermark of the raw rows, minus the 5-day overlap,
    and the rows an incremental run reads again (per file)."""
    raw = _with_file_date(_raw(spark, sf_dir))
    wm = raw.agg(F.max(F.try_to_timestamp(F.col("file_date_raw"))).cast("timestamp_ntz")).scalar()
    since = wm - F.expr("INTERVAL 5 DAYS")
    fetched = raw.filter(F.col("file_date") >= since)
    return fetched.groupBy("source_file").agg(F.max("file_date").alias("file_date"),
                                              F.count(F.lit(1)).cast("int").alias("n_rows"))


def q_new_files(spark, sf_dir):
    raw = _with_file_date(_raw(spark, sf_dir))
    listing = raw.select(F.col("source_file").alias("name"))
    candidates = SF.matching_files(listing, FILE_SUBSTRING, FILE_SUFFIX, ONLY_YEARS)
    loaded = raw.filter(F.col("file_date") <= F.lit(BATCH1_LAST_DAY).cast("timestamp_ntz")) \
        .select("source_file").distinct()
    fresh = SF.new_files(candidates, loaded)
    return fresh.select("name", SF.file_date_from_name("name", FILE_SUBSTRING, FILE_SUFFIX).alias("file_date"))


def q_file_metadata(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return (SF.file_metrics(raw, "source_file")
            .select("source_file", SF.file_date_from_name("source_file", FILE_SUBSTRING, FILE_SUFFIX)
                    .alias("file_date"), "n_rows"))


def q_page_links(spark, sf_dir):
    ensure_session(spark)
    return LK.extract_links(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def q_leg_distances(spark, sf_dir):
    legs = _legs(spark, sf_dir).dropna(subset=list(COORD_COLUMNS))
    x0, y0 = GEO.project("start_longitude", "start_latitude")
    x1, y1 = GEO.project("end_longitude", "end_latitude")
    return legs.select("event_id",
                       F.round(x0, 3).alias("start_x"), F.round(y0, 3).alias("start_y"),
                       F.round(x1, 3).alias("end_x"), F.round(y1, 3).alias("end_y"),
                       F.round(GEO.manhattan_miles(x0, y0, x1, y1), ROUND).alias("manhattan_distance_mi"),
                       F.round(GEO.euclidean_miles(x0, y0, x1, y1), ROUND).alias("euclidean_distance_mi"))


def q_block_group_join(spark, sf_dir):
    ensure_session(spark)
    pts = FX.grid_points(spark, sf_dir)
    out = SP.assign_origin_destination(pts, FX.grid_polygons(spark), cell=0.01,
                                       start=("lon", "lat"), end=("end_lon", "end_lat"))
    return out.select("event_id", "Origin_BG", "Dest_BG")


def q_block_group_shapes(spark, sf_dir):
    """J1 / D-7: triangles, holes, hollow and slanted shapes that overlap: the
    smallest id that contains a point, and how many do."""
    ensure_session(spark)
    points = FX.shape_points(spark, sf_dir)
    cells, _ = written(SP.split_cells(FX.shape_polygons(spark, sf_dir), points, "lon", "lat", 0.005), "polygon-cells")
    out = SP.assign_polygon(points, cells, "lon", "lat", "bg_id", 0.005, count_out="n_containing")
    return out.select("event_id", "bg_id", "n_containing")


def q_leg_sequence_hot(spark, sf_dir):
    """W1-W3 where one trip holds a third of all legs, through the split path."""
    ensure_session(spark)
    f = FL.flags(FX.hot_legs(spark, sf_dir), FX.AS_OF, FX.DAYS_BACK, tie_break=FX.TIE_BREAK, rows_per_task=HOT_ROWS)
    return f.select("event_id", "user_trip_id", "trip_date", *SEQ_COLUMNS)


def q_reject_split(spark, sf_dir):
    """B2 / D-6: the route of every raw row, and why."""
    ensure_session(spark)
    routed = CL.route_clean(FX.reject_raw(spark, sf_dir), keep=("event_id",))
    return routed.select("event_id", "route", "reject_reason", "trip_date")


def q_csv_legs(spark, sf_dir):
    """Files of four layouts and one broken file, written from the
    raw rows, staged and read back: the rows that load (good records of every
    file), and the records and files in quarantine."""
    ensure_session(spark)
    landing = scratch_path(spark, "landing")
    FX.write_csv_landing(spark, sf_dir, landing)
    files = [r["path"] for r in SF.matching_files(SF.list_files(spark, landing), "", ".txt").select("path").collect()]
    staged = CSV.stage(spark, files, whole_files=False)
    text = [F.col(c).alias(c) for c in FX.CSV_FIELDS[1:]]
    good = staged.good.select(F.col("event_id").cast("long").alias("event_id"), *text, F.lit("loaded").alias("outcome"))
    held = staged.quarantine.where("kind = 'record'").select(
        F.from_csv("record", F.lit("event_id long")).getField("event_id").alias("event_id"),
        *[F.lit(None).cast("string").alias(c) for c in FX.CSV_FIELDS[1:]], F.col("reason").alias("outcome"))
    files = staged.quarantine.where("kind = 'file'").select(
        F.lit(None).cast("long").alias("event_id"), *[F.lit(None).cast("string").alias(c) for c in FX.CSV_FIELDS[1:]],
        F.col("reason").alias("outcome")).distinct()
    return good.unionByName(held).unionByName(files)


def q_refresh_written(spark, sf_dir):
    """A whole refresh, written as one version and committed; what
    readers then find in each table."""
    ensure_session(spark)
    base = scratch_path(spark, "refreshed")
    run_refresh(spark, FX.legs(spark, sf_dir), base, FX.AS_OF, FX.DAYS_BACK, tie_break=FX.TIE_BREAK)
    out = None
    for name, measure in WRITTEN_MEASURES.items():
        df = read_refreshed(spark, base, name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                                   F.sum(measure).cast("long").alias("total"))
        out = df if out is None else out.unionByName(df)
    return out


#: Rows of a trip from which the hot path splits it, in its query.
HOT_ROWS = 256
#: A count of each refreshed table that its query adds up.
WRITTEN_MEASURES = {
    "Flow_BG_BG_Daily": "leg_count", "Transfer_Hotspots_Daily": "transfer_events", "BG_Summary_Daily": "legs",
    "Flow_BG_BG_Daily_Route": "leg_count", "Transfer_Hotspots_Daily_Route": "transfer_events",
    "Transfer_Hotspots_Daily_RoutePair": "transfer_events", "Walk_AccessEgress_Daily": "walk_leg_count",
    "ArcGIS_Flow_BG_BG_Daily_Route_Rolling31": "oid", "ArcGIS_Transfer_Hotspots_Daily_Route_Rolling31": "oid",
    "ArcGIS_Walk_Egress_Daily_Rolling31": "oid"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "leg_base": q_leg_base,
    "leg_sequence": q_leg_sequence,
    "leg_sequence_hot": q_leg_sequence_hot,
    "reject_split": q_reject_split,
    "csv_legs": q_csv_legs,
    "refresh_written": q_refresh_written,
    "transfer_flags": q_transfer_flags,
    "region_filtered_flags": q_region_filtered_flags,
    "flow_daily": q_flow_daily,
    "flow_daily_route": q_flow_daily_route,
    "transfer_hotspots": q_transfer_hotspots,
    "transfer_hotspots_route": q_transfer_hotspots_route,
    "transfer_hotspots_routepair": q_transfer_hotspots_routepair,
    "bg_summary": q_bg_summary,
    "walk_access": q_walk_access,
    "walk_egress": q_walk_egress,
    "walk_access_egress": q_walk_access_egress,
    "publish_flows": q_publish_flows,
    "publish_hotspots": q_publish_hotspots,
    "publish_walk_egress": q_publish_walk_egress,
    "flow_lines": q_flow_lines,
    "hotspot_points": q_hotspot_points,
    "walk_egress_lines": q_walk_egress_lines,
    "hotspot_hash_backfill": q_hotspot_hash_backfill,
    "validate_flows": q_validate_flows,
    "validate_hotspots": q_validate_hotspots,
    "validate_walk_top10": q_validate_walk_top10,
    "clean_legs": q_clean_legs,
    "row_hash": q_row_hash,
    "incremental_upsert": q_incremental_upsert,
    "incremental_since": q_incremental_since,
    "new_files": q_new_files,
    "file_metadata": q_file_metadata,
    "page_links": q_page_links,
    "leg_distances": q_leg_distances,
    "block_group_join": q_block_group_join,
    "block_group_shapes": q_block_group_shapes,
}
