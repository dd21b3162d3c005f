"""The rolling-window refresh — flags -> 7 aggregates -> 3 publish tables.

``refresh`` returns lazy DataFrames; ``write_refresh`` overwrites the target
tables (a static overwrite: days that left the window disappear).

The flags are computed once and read by all seven aggregates. At scale they
are written as Parquet to the shared checkpoint folder (``materialize=
"parquet"``): that cuts the lineage, survives lost executors, and lets each
aggregate read only the columns it needs. ``"persist"`` keeps them in
executor memory/disk instead (good for small local runs), ``"none"`` leaves
one plan per aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from legwise.operators import aggregates as G
from legwise.operators import publish as P
from legwise.operators.flags import flags as build_flags
from legwise.plans.versions import VersionedTables
from legwise.schemas import TABLES
from legwise.session import ensure_session, scratch_path, scratch_scope, tune_shuffle_partitions

AGGREGATE_TABLES = ("Flow_BG_BG_Daily", "Transfer_Hotspots_Daily", "BG_Summary_Daily",
                    "Flow_BG_BG_Daily_Route", "Transfer_Hotspots_Daily_Route",
                    "Transfer_Hotspots_Daily_RoutePair", "Walk_AccessEgress_Daily")
ROUTEPAIR = "Transfer_Hotspots_Daily_RoutePair"
PUBLISH_TABLES = ("ArcGIS_Flow_BG_BG_Daily_Route_Rolling31",
                  "ArcGIS_Transfer_Hotspots_Daily_Route_Rolling31",
                  "ArcGIS_Walk_Egress_Daily_Rolling31")


@dataclass
class RefreshResult:
    flags: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)
    _persisted: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()


def materialize_flags(flags: DataFrame, how: str) -> tuple[DataFrame, list[DataFrame]]:
    spark = flags.sparkSession
    if how == "parquet":
        path = scratch_path(spark, "flags")
        flags.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path), []
    if how == "persist":
        f = flags.persist(StorageLevel.MEMORY_AND_DISK)
        return f, [f]
    if how == "none":
        return flags, []
    raise ValueError(f"materialize must be 'parquet', 'persist' or 'none', not {how!r}")


def publish_tables(tables: dict[str, DataFrame], as_of=None, days_back: int = 31) -> dict[str, DataFrame]:
    """The three numbered publish tables from the aggregate tables."""
    return {
        "ArcGIS_Flow_BG_BG_Daily_Route_Rolling31":
            P.publish_flows(tables["Flow_BG_BG_Daily_Route"], as_of, days_back),
        "ArcGIS_Transfer_Hotspots_Daily_Route_Rolling31":
            P.publish_hotspots(tables["Transfer_Hotspots_Daily_Route"], as_of, days_back),
        "ArcGIS_Walk_Egress_Daily_Rolling31":
            P.publish_walk_egress(tables["Walk_AccessEgress_Daily"], as_of, days_back),
    }


def refresh(spark: SparkSession, clean: DataFrame, as_of=None, days_back: int = 31,
            region_prefix: str | None = None, tie_break: str | None = "row_hash",
            materialize: str = "parquet", hot_keys="auto", with_publish: bool = True,
            rows_per_task: int | None = None) -> RefreshResult:
    """Build the seven aggregates (and, with ``with_publish``, the three
    publish tables) over ``[as_of - days_back, as_of)``; ``as_of`` defaults to
    today. Aggregates are lazy; numbering a publish table runs one job."""
    ensure_session(spark)
    kw = {"rows_per_task": rows_per_task} if rows_per_task else {}
    f = build_flags(clean, as_of, days_back, region_prefix, tie_break, hot_keys=hot_keys, **kw)
    f, persisted = materialize_flags(f, materialize)
    tables = G.all_aggregates(f)
    if with_publish:
        tables.update(publish_tables(tables, as_of, days_back))
    return RefreshResult(flags=f, tables=tables, _persisted=persisted)


def _write(df: DataFrame, path: str, partitioned: bool, fmt: str) -> None:
    if partitioned:  # rows of a day meet before they are written
        df = df.hint("rebalance", "trip_date")
    w = df.write.mode("overwrite").format(fmt)
    (w.partitionBy("trip_date") if partitioned else w).save(path)


def run_refresh(spark: SparkSession, clean: DataFrame, base_path: str, as_of=None, days_back: int = 31,
                region_prefix: str | None = None, tie_break: str | None = "row_hash",
                materialize: str = "parquet", fmt: str = "parquet", tune_shuffle: bool = False) -> dict[str, str]:
    """B4 + B5 + T7: build the seven aggregate tables (partitioned by
    ``trip_date``) and the publish tables (from the *written* aggregates) as one
    new version below ``base_path``, then commit it. A failure before the commit
    leaves the old version as it is. Returns ``{table: path}``. With
    ``tune_shuffle`` the shuffle partition count is sized from the window's input
    estimate first."""
    if tune_shuffle:
        from legwise.operators.flags import base_filter
        tune_shuffle_partitions(spark, clean.filter(base_filter(as_of, days_back, region_prefix)))
    store = VersionedTables(spark, base_path)
    version = store.begin()
    paths = {}
    with scratch_scope(spark):  # flags and numbered rows
        result = refresh(spark, clean, as_of, days_back, region_prefix, tie_break, materialize,
                         with_publish=False)
        try:
            for name in AGGREGATE_TABLES:
                paths[name] = store.path(name, version)
                source = result.tables[name]
                if name == ROUTEPAIR:  # a projection of the route table, which is written by now
                    source = G.transfer_hotspots_routepair(_stored(spark, "Transfer_Hotspots_Daily_Route", paths, fmt))
                _write(source, paths[name], True, fmt)
        finally:
            result.release()
        stored = {name: _stored(spark, name, paths, fmt) for name in AGGREGATE_TABLES}
        for name, df in publish_tables(stored, as_of, days_back).items():
            paths[name] = store.path(name, version)
            _write(df, paths[name], False, fmt)
    store.commit(version, sorted(paths))
    return paths


def _stored(spark: SparkSession, name: str, paths: dict[str, str], fmt: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).format(fmt).load(paths[name])


def read_refreshed(spark: SparkSession, base_path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A10: a table of the version that is committed below ``base_path``."""
    return spark.read.schema(TABLES[name]).format(fmt).load(VersionedTables(spark, base_path).path(name))
