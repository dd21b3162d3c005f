"""Ingest new landing files into the raw table.

Discovery (A1-A4) -> every new file parsed once into a staged table, whatever
its header (A5) -> enrichment as column expressions (C1-C4, F1, M1-M3) -> block
groups by the polygon join (J1/J2) -> append to raw, partitioned by ``file_date``
(B1). Files and records that cannot load go to the quarantine table with their
reason and text. What is loaded stands in the manifest, so that raw is not read.

Order of effects: quarantine, intents, raw (one job: all files or none), loaded
events. A run that dies in between is settled by the next one: files whose rows
reached raw count as loaded, the others are read again.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from legwise.config import IngestConfig
from legwise.functions import geo as GEO
from legwise.operators.clean import to_number
from legwise.operators.spatial import assign_origin_destination
from legwise.schemas import COORD_COLUMNS, RAW
from legwise.session import drop_scratch, ensure_session, path_exists
from legwise.sources import csv_legs as CS
from legwise.sources import files as SF
from legwise.sources.manifest import Manifest
from legwise.sources.polygons import read_polygons

log = logging.getLogger(__name__)


def enrich(df: DataFrame, cfg: IngestConfig, polygons: DataFrame | None) -> DataFrame:
    """C2 + C4 + F1 + M1-M3 + J1/J2 on CSV rows that carry ``source_file``."""
    missing = [c for c in COORD_COLUMNS if c not in df.columns]
    if missing:  # C3
        raise KeyError(f"expected column(s) {missing} not found in the leg files")
    df = df.withColumn("file_date", SF.file_date_from_name("source_file", cfg.filename_substring,
                                                           cfg.file_suffix))
    for c in COORD_COLUMNS:
        df = df.withColumn(c, to_number(c))
    df = df.dropna(subset=list(COORD_COLUMNS))  # F1
    manhattan, euclidean = GEO.leg_distances("start_longitude", "start_latitude",
                                             "end_longitude", "end_latitude", cfg.dist_epsg)
    df = df.withColumn("manhattan_distance_mi", manhattan).withColumn("euclidean_distance_mi", euclidean)
    if polygons is not None:
        df = assign_origin_destination(df, polygons, cfg.cell_size_deg)
    else:
        df = df.withColumn("Origin_BG", F.lit(None).cast("string")).withColumn("Dest_BG", F.lit(None).cast("string"))
    known = [f.name for f in RAW.fields]
    extra = [c for c in df.columns if c not in known]
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW.fields], *extra)


def quarantine_path(raw_path: str) -> str:
    return raw_path.rstrip("/") + "_quarantine"


@dataclass
class IngestResult:
    """``n_rows``: rows appended to raw; ``loaded``: files; ``quarantined``: reason by path."""
    n_rows: int = 0
    loaded: list[str] = field(default_factory=list)
    quarantined: dict[str, str] = field(default_factory=dict)


def settle(spark: SparkSession, cfg: IngestConfig, manifest: Manifest) -> None:
    """Outcome of the intents a dead run left: one look at the raw partitions of
    just their file dates."""
    left = manifest.unsettled()
    if not left:
        return
    there: set[str] = set()
    if path_exists(spark, cfg.raw_path):
        names = spark.createDataFrame([(r["name"],) for r in left], "name string").distinct()
        dates = names.select(F.col("name").alias("source_file"), SF.file_date_from_name(
            "name", cfg.filename_substring, cfg.file_suffix).alias("file_date"))
        raw = spark.read.schema("source_file string, file_date timestamp_ntz").parquet(cfg.raw_path)
        there = {r["source_file"] for r in raw.join(F.broadcast(dates), (raw["source_file"] == dates["source_file"])
                                                    & raw["file_date"].eqNullSafe(dates["file_date"]), "left_semi")
                 .select("source_file").distinct().collect()}
    for event, chosen in (("loaded", [r for r in left if r["name"] in there]),
                          ("void", [r for r in left if r["name"] not in there])):
        for run_id in {r["run_id"] for r in chosen}:
            manifest.record(run_id, event, [(r["path"], r["name"], r["length"], None) for r in chosen
                                            if r["run_id"] == run_id])


def discover_new_files(spark: SparkSession, cfg: IngestConfig, manifest: Manifest | None = None) -> list:
    """A1-A4 + J3: rows (path, key, name, length) of matching files that are not
    loaded yet, oldest name first, at most ``cfg.max_files`` of them (the rest
    come with the next run). Raw is not read."""
    manifest = manifest or Manifest(spark, cfg.raw_path)
    listing = SF.list_files(spark, cfg.landing_path)
    found = SF.matching_files(listing, cfg.filename_substring, cfg.file_suffix, cfg.only_years)
    below = SF.below_folder("path", cfg.landing_path)
    fresh = manifest.fresh(found.select(F.col("path").alias("url"), below.alias("path"), "name", "length"))
    return fresh.orderBy("name", "path").limit(cfg.max_files).collect()


def ingest_files(spark: SparkSession, cfg: IngestConfig, files: list, polygons: DataFrame | None,
                 manifest: Manifest) -> IngestResult:
    """Load ``files`` (rows with url, path, name, length) as one unit."""
    run_id = uuid.uuid4().hex[:12]
    staged = CS.stage(spark, [f["url"] for f in files], whole_files=cfg.whole_files)
    out = IngestResult(quarantined=dict(staged.broken))
    try:
        seen = Observation("quarantine")
        (staged.quarantine.withColumn("at", F.localtimestamp())
         .observe(seen, F.collect_set(F.when(F.col("kind") == "record", F.col("path"))).alias("paths"))
         .write.mode("overwrite").parquet(f"{quarantine_path(cfg.raw_path)}/run_id={run_id}"))
        bad_records = set(seen.get.get("paths") or [])
        out.quarantined.update({p: "bad records" for p in bad_records})
        refused = set(staged.broken) | (bad_records if cfg.whole_files else set())
        taken = [f for f in files if f["url"] not in refused]
        if staged.good is None or not taken:
            return out
        keys = [(f["path"], f["name"], f["length"], None) for f in taken]
        manifest.record(run_id, "intent", keys)
        rows = enrich(staged.good.drop(CS.PATH), cfg, polygons)
        done = Observation("ingest")
        rows = rows.observe(done, F.count(F.lit(1)).alias("n"))
        # rows of a day meet before they are written; AQE splits large days and joins small ones
        rows.hint("rebalance", "file_date").write.mode("append").partitionBy("file_date").parquet(cfg.raw_path)
        manifest.record(run_id, "loaded", keys)
        out.n_rows, out.loaded = int(done.get.get("n", 0) or 0), [f["path"] for f in taken]
        return out
    finally:
        drop_scratch(spark, staged.paths)


def run_ingest(spark: SparkSession, cfg: IngestConfig, polygons: DataFrame | None = None) -> IngestResult:
    """Load every new landing file (``cfg.max_files`` at most)."""
    ensure_session(spark)
    manifest = Manifest(spark, cfg.raw_path)
    manifest.adopt()
    settle(spark, cfg, manifest)
    files = discover_new_files(spark, cfg, manifest)
    log.info("new files to ingest: %d", len(files))
    if not files:
        return IngestResult()
    if polygons is None and cfg.polygons_path:
        polygons = read_polygons(spark, cfg.polygons_path, cfg.polygon_id_field)
    result = ingest_files(spark, cfg, files, polygons, manifest)
    manifest.compact()
    for path, reason in sorted(result.quarantined.items()):
        log.warning("quarantined %s: %s", path, reason)
    log.info("rows inserted: %d", result.n_rows)
    return result


def ingest(spark: SparkSession, cfg: IngestConfig, polygons: DataFrame | None = None) -> int:
    """Load every new landing file; returns the number of raw rows appended."""
    return run_ingest(spark, cfg, polygons).n_rows
