"""Helpers shared by the llm operators: table access, written cuts of the
lineage, deterministic row numbers and distributed connected components."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwise.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends at files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give memory that is no longer used back to the system: Spark keeps idle
    Python workers, and what they hold counts against their executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and its n + 1 offsets; null
    counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int):
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone),
    so that work arrays stay bounded whatever Arrow puts into one batch."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)


def word_spans(space: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``space`` is false, cut at the text
    bounds ``at``."""
    edge = np.zeros(len(space) + 1, bool)
    edge[at] = True
    before = np.concatenate([[True], space[:-1]]) | edge[:-1]
    after = np.concatenate([space[1:], [True]]) | edge[1:]
    return np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: polynomial hashes from running sums, shifted
    back to the start of the span."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[low]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(_BASE, len(low)), dtype=np.uint64)])
    shift = powers(pow(_BASE, -1, 1 << 64), len(low))
    return mix((sums[ends] - sums[starts]) * shift[starts] + (ends - starts).astype(np.uint64))


def word_hashes(low: np.ndarray, space: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of each word of the texts low[at[i]:at[i+1]];
    words are the runs where ``space`` is false."""
    if not len(low):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts, ends = word_spans(space, at)
    return np.searchsorted(at, starts, side="right") - 1, span_hashes(low, starts, ends)


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long), as (node, root):
    root is the smallest node reachable; nodes without edges are not listed.

    Alternating large-star / small-star rounds. Every round is one written
    table, so a lost executor costs one round at most; a hub is reduced by the
    partial aggregation of ``min`` and its join is split by AQE.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .where("u > v").distinct())
    e = cut(e, name)
    mark = _mark(e)
    for _ in range(max_rounds):
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (sym.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low2, "u")
        small = (joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                 F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u > v").distinct())
        e = cut(small, name)
        now = _mark(e)
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
    raise RuntimeError("connected components did not settle")


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]
