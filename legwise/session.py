"""Session helpers: configuration every job relies on, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings the engine's semantics depend on (times are UTC wall clock, ANSI
# arithmetic, runtime re-planning for skewed shuffles).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str = "local[*]", app_name: str = "legwise",
                  shuffle_partitions: int | None = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, benchmarks and local runs. On a cluster, create the
    session with the cluster's own settings and call :func:`ensure_session`."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = {**RECOMMENDED_CONF, **REQUIRED_CONF,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.execution.arrow.pyspark.enabled": "true"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on. Times in this engine are UTC wall
    clock (``timestamp_ntz``); text with an offset is converted to UTC."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local-mode session without one gets a fresh temporary folder; a cluster job
    without a shared folder fails rather than write to a machine-local path.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster job needs a "
                           "shared folder for checkpoints")
    d = tempfile.mkdtemp(prefix="legwise-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


#: Intermediate tables by owner: the outermost list belongs to the process, each
#: open ``scratch_scope`` of a thread has its own.
_SCRATCH: list[str] = []
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scratch scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for a written table. The
    innermost open scope owns it, else the process (:func:`cleanup_scratch`)."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    scopes = _SCOPES.get()
    (scopes[-1] if scopes else _SCRATCH).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables written inside are deleted at the end, and only
    those. What leaves the scope must have been written elsewhere."""
    own: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield own
    finally:
        _SCOPES.reset(token)
        drop_scratch(spark, own)


def cleanup_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far (call once every
    DataFrame reading them has been written out). Returns how many."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete these intermediate tables, and no others."""
    for path in list(paths):
        for owned in (_SCRATCH, *_SCOPES.get()):
            if path in owned:
                owned.remove(path)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df, name: str):
    """Write ``df`` once below the shared checkpoint folder and read it back, so
    that every later use sees the same rows. Returns (table, path)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its (possibly remote) file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def tune_shuffle_partitions(spark: SparkSession, df, target_bytes: int = TARGET_PARTITION_BYTES,
                            max_partitions: int = 200_000) -> int:
    """Size the initial shuffle partition count from Catalyst's estimate of
    ``df``'s input so that a shuffle partition stays near ``target_bytes``
    (AQE then coalesces small ones). Only raises the setting, never lowers
    it; returns the value in effect."""
    est = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    want = min(max_partitions, max(1, -(-est // target_bytes)))
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if want > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(want))
        return want
    return current
