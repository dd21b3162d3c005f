"""Structured Streaming form of the clean step.

The stream is the raw table as it grows. Rows are cleaned as in the batch run;
copies that arrive within the overlap (``overlap_days`` behind the newest file
date, the stream's watermark) are dropped by their row hash from bounded state
that the checkpoint keeps; what is left is merged against the stored table, so
copies that are older than the state, and a micro-batch that is replayed, add
nothing either. Rows of files that are later than the overlap are not read again,
as in the batch run.

Undated rows have no place in event time and would hold the watermark back; a
second query takes them straight to the reject table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from legwise.config import TransformConfig
from legwise.operators.clean import CLEAN_ROUTE, EXTRACT_COLUMNS, UNDATED, route_clean
from legwise.operators.upsert import new_rows
from legwise.plans.transform import keep_rejects
from legwise.schemas import CLEAN, RAW, read_table
from legwise.session import ensure_session, path_exists

EVENT_TIME = "_file_time"


def raw_stream(spark: SparkSession, raw_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Rows of the raw table, routed, with the time of their file."""
    r = spark.readStream.schema(RAW)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.parquet(raw_path).withColumn(EVENT_TIME, F.col("file_date").cast("timestamp"))
    columns = [F.col("file_date").alias(c) if c == "file_date_raw" else F.col(c) for c in EXTRACT_COLUMNS]
    return route_clean(raw.select(EVENT_TIME, *columns), keep=(EVENT_TIME,))


def once_within_overlap(routed: DataFrame, overlap_days: int) -> DataFrame:
    """T4 / T5: each dated row once, as far back as the watermark reaches."""
    return (routed.where(F.col("route") != UNDATED).withWatermark(EVENT_TIME, f"{overlap_days} days")
            .dropDuplicatesWithinWatermark(["row_hash", "reject_reason"]))


def _reject_path(cfg: TransformConfig) -> str:
    return cfg.reject_path or cfg.clean_path.rstrip("/") + "_rejects"


def start_clean_stream(spark: SparkSession, cfg: TransformConfig, checkpoint: str, available_now: bool = True,
                       processing_time: str | None = None,
                       max_files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """Start both queries; ``available_now`` processes what is there and stops."""
    ensure_session(spark)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.drop(EVENT_TIME).persist()
        try:
            good = batch.where(F.col("route") == CLEAN_ROUTE).select(*CLEAN.names)
            stored = read_table(batch.sparkSession, cfg.clean_path, "LegTrips_Clean") \
                if path_exists(batch.sparkSession, cfg.clean_path) else None
            new_rows(good, stored).write.mode("append").partitionBy("trip_date").parquet(cfg.clean_path)
            keep_rejects(batch, _reject_path(cfg))
        finally:
            batch.unpersist()

    def undated(batch: DataFrame, epoch_id: int) -> None:
        keep_rejects(batch.drop(EVENT_TIME), _reject_path(cfg) + "_undated")

    routed = raw_stream(spark, cfg.raw_path, max_files_per_trigger)
    queries = []
    for name, df, handle in (("dated", once_within_overlap(routed, cfg.overlap_days), merge),
                             ("undated", routed.where(F.col("route") == UNDATED), undated)):
        w = df.writeStream.foreachBatch(handle).option("checkpointLocation", f"{checkpoint}/{name}")
        if available_now:
            w = w.trigger(availableNow=True)
        elif processing_time:
            w = w.trigger(processingTime=processing_time)
        queries.append(w.start())
    return queries
