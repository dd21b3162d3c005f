"""Structured Streaming form of ingest.

The stream is the landing folder's files, not their rows: the file source
remembers in its checkpoint which files it has handed out, and each micro-batch
loads its files as one unit, exactly like the batch ingest (any header,
quarantine, manifest). A replayed micro-batch (after a failure between write and
commit) finds its files in the manifest and adds nothing (T5). Optionally each
micro-batch runs the incremental transform and the rolling refresh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from legwise.config import IngestConfig, TransformConfig
from legwise.plans.ingest import ingest_files, settle
from legwise.plans.transform import transform
from legwise.schemas import RAW_INPUT_COLUMNS
from legwise.session import ensure_session
from legwise.sources import files as SF
from legwise.sources.manifest import Manifest
from legwise.sources.polygons import read_polygons


#: The columns of a table of files.
FILES = "path string, modificationTime timestamp, length long, content binary"


def landing_stream(spark: SparkSession, cfg: IngestConfig, max_files_per_trigger: int | None = None) -> DataFrame:
    """New landing files: url, path below the folder, name, length. Contents are
    not read."""
    r = (spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
         .option("pathGlobFilter", f"*{cfg.filename_substring}*{cfg.file_suffix}"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(cfg.landing_path).select(F.col("path").alias("url"), SF.below_folder("path", cfg.landing_path).alias("path"),
                                         SF.base_name("path").alias("name"), "length")
    return df.filter(SF.year_allowed("name", cfg.only_years))


def leg_file_stream(spark: SparkSession, cfg: IngestConfig, max_files_per_trigger: int | None = None,
                    header: tuple[str, ...] = RAW_INPUT_COLUMNS) -> DataFrame:
    """The landing folder as a stream of CSV rows. A stream's schema is fixed
    up front: ``header`` is the files' column order, and each file's header is
    checked against it (a file with another layout fails the micro-batch)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    r = (spark.readStream.format("csv").schema(schema).option("header", "true")
         .option("enforceSchema", "false")
         .option("pathGlobFilter", f"*{cfg.filename_substring}*{cfg.file_suffix}"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(cfg.landing_path).select("*", F.col("_metadata.file_name").alias("source_file"))
    for c in RAW_INPUT_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.filter(SF.year_allowed("source_file", cfg.only_years))


def start_ingest_stream(spark: SparkSession, cfg: IngestConfig, checkpoint: str,
                        polygons: DataFrame | None = None, transform_cfg: TransformConfig | None = None,
                        available_now: bool = True, processing_time: str | None = None,
                        max_files_per_trigger: int | None = None, today=None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.
    Names of one micro-batch's files reach the driver (``max_files_per_trigger``
    at most)."""
    ensure_session(spark)
    shapes = polygons if polygons is not None or not cfg.polygons_path else read_polygons(spark, cfg.polygons_path, cfg.polygon_id_field)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        manifest = Manifest(spark, cfg.raw_path)
        manifest.adopt()
        settle(spark, cfg, manifest)
        files = manifest.fresh(batch).orderBy("name", "path").collect()
        if files:
            ingest_files(spark, cfg, files, shapes, manifest)
            manifest.compact()
        if transform_cfg is not None:
            transform(spark, transform_cfg, today=today)

    w = (landing_stream(spark, cfg, max_files_per_trigger).writeStream
         .foreachBatch(handle).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
