"""P5 + B6: build map features from the publish tables and overwrite the
feature datasets (WKT in Parquet, or GeoJSON features one per line).

``dry_run`` builds every feature DataFrame and its plan but writes nothing.
A missing publish table raises ``FileNotFoundError``.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwise.config import PublishConfig
from legwise.operators import publish as P
from legwise.plans.versions import VersionedTables
from legwise.session import ensure_session

log = logging.getLogger(__name__)

LAYERS = {
    "flows": ("ArcGIS_Flow_BG_BG_Daily_Route_Rolling31", "line"),
    "transfer_hotspots": ("ArcGIS_Transfer_Hotspots_Daily_Route_Rolling31", "point"),
    "walk_egress": ("ArcGIS_Walk_Egress_Daily_Rolling31", "line"),
}


def features(table: DataFrame, kind: str, densify: int = 0) -> DataFrame:
    if kind == "point":
        return P.hotspot_points(table).withColumn("geojson", P.point_geojson("mean_lon", "mean_lat"))
    return (P.flow_lines(table, densify)
            .withColumn("geojson", P.line_geojson("mean_start_lon", "mean_start_lat", "mean_end_lon", "mean_end_lat",
                                                  densify)))


def as_geojson_lines(df: DataFrame) -> DataFrame:
    """One GeoJSON Feature per row (``value`` text)."""
    props = [c for c in df.columns if c not in ("wkt", "geojson", "srid")]
    return df.select(F.concat(F.lit('{"type":"Feature","geometry":'), F.col("geojson"),
                              F.lit(',"properties":'), F.to_json(F.struct(*props), {"ignoreNullFields": "false"}), F.lit("}")).alias("value"))


def write_features(df: DataFrame, path: str, fmt: str = "parquet", dry_run: bool = False) -> DataFrame:
    """Overwrite one feature dataset; in a dry run only the plan is built."""
    out = as_geojson_lines(df) if fmt == "geojson" else df.drop("geojson")
    if dry_run:
        log.info("dry run: would overwrite %s", path)
        return out
    if fmt == "geojson":
        out.write.mode("overwrite").text(path)
    else:
        out.write.mode("overwrite").parquet(path)
    return out


def publish(spark: SparkSession, cfg: PublishConfig) -> dict[str, DataFrame]:
    ensure_session(spark)
    store, built = VersionedTables(spark, cfg.output_path), {}
    version = store.current()  # all layers from one version
    for layer, (table, kind) in LAYERS.items():
        if not store.exists(table):
            raise FileNotFoundError(f"publish table not found: {table} below {cfg.output_path}")
        feats = features(spark.read.parquet(store.path(table, version)), kind, cfg.densify)
        built[layer] = write_features(feats, f"{cfg.features_path.rstrip('/')}/{layer}", cfg.fmt, cfg.dry_run)
    return built
