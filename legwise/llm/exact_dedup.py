"""Operator 1: exact deduplication by a heavy-hitter split.

Every text gets a SHA-256 digest on the JVM. A Misra-Gries summary per task
finds digests that may be frequent; their exact counts and winners are verified
by a map-side reduced aggregation. The verified winners (at most ``counters``
rows) are broadcast, so frequent texts are resolved where they are read. Only
the remaining digests are shuffled, and none of those can hold more than about
2 / counters of all rows.

Defined results: a null text counts as empty; a null id sorts below all ids;
rows with the same id and the same text are ties, of which exactly one stays;
an empty input gives an empty result; other columns, whatever their names, are
not read (:func:`exact_dedup`) or carried along (:func:`drop_copies`).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legwise.llm.common import cut

#: Misra-Gries counters per task, and the most winners that are broadcast.
COUNTERS = 1024


def text_digest(text_col: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))


def _misra_gries(counters: int):
    def run(batches):
        held: dict[bytes, int] = {}
        for batch in batches:
            counts = batch.column(0).value_counts()
            for digest, n in zip(counts.field(0).to_pylist(), counts.field(1).to_pylist()):
                if digest in held:
                    held[digest] += n
                    continue
                held[digest] = n
                if len(held) > counters:
                    low = min(held.values())
                    held = {d: c - low for d, c in held.items() if c > low}
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(held), pa.binary()), "n": pa.array(list(held.values()), pa.int64())})
    return run


def heavy_candidates(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each one that holds more than
    2 / counters of the rows. Per task the summary undercounts a digest by at
    most n / counters; so do the sums, and fewer than ``counters`` digests can
    have a sum above N / counters."""
    found = digests.select("digest").mapInArrow(_misra_gries(counters), "digest binary, n long")
    return (found.groupBy("digest").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "digest").limit(counters).select("digest"))


def heavy_winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, win, n) of the frequent digests: exact counts and the winner
    (largest doc_id, then row_key), verified over all rows. Written, because
    several branches must agree on it."""
    likely = cut(heavy_candidates(rows, counters), "dedup-likely")
    exact = (rows.join(F.broadcast(likely), "digest", "left_semi")
             .groupBy("digest").agg(F.max(F.struct("doc_id", "row_key")).alias("win"),
                                    F.count(F.lit(1)).alias("n")))
    return cut(exact.where("n > 1"), "dedup-winners")


def fingerprints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row_key, digest) of every row, written once: row_key tells
    repeated rows apart."""
    return cut(df.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row_key"),
                         text_digest(text_col).alias("digest")), "dedup-digests")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = fingerprints(df, id_col, text_col)
    heavy = heavy_winners(rows, counters)
    split = rows.join(F.broadcast(heavy), "digest", "left")
    by_digest = Window.partitionBy("digest")
    rest = (split.where("n IS NULL").select("doc_id", "row_key", "digest")
            .withColumn("win", F.max(F.struct("doc_id", "row_key")).over(by_digest))
            .withColumn("n", F.count(F.lit(1)).over(by_digest)))
    return (split.where("n IS NOT NULL").unionByName(rest)
            .select("doc_id", F.col("win.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("row_key") == F.col("win.row_key")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with exactly the columns of ``df``. Losing copies of
    frequent texts are removed where they are read; the others meet by digest."""
    rows = fingerprints(df, id_col, text_col)
    heavy = heavy_winners(rows, counters).select(F.col("digest").alias("heavy_digest"),
                                                 F.col("win.doc_id").alias("heavy_id"))
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                      text_digest(text_col).alias("digest"), F.col(id_col).alias("doc_id"))
    left = (whole.join(F.broadcast(heavy), F.col("digest") == F.col("heavy_digest"), "left")
            .where(F.col("heavy_digest").isNull() | F.col("doc_id").eqNullSafe(F.col("heavy_id"))))
    first = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("row"))
    return (left.withColumn("place", F.row_number().over(first)).where("place = 1").select("row.*"))
