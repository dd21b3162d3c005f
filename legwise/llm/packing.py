"""Operator 6: best-fit packing planned on the length histogram.

Documents are tokenised once into pieces (a document of more than ``capacity``
tokens is cut from its end, so only its first piece may be shorter). Only the
histogram of piece lengths (at most ``capacity`` rows) reaches the driver, where
best-fit decreasing runs over counts: bins with equal contents are one interval.
The plan is a list of runs "ranks lo..hi of length n go to bins from b on, at
offset o"; its size depends on ``capacity`` alone, not on the data (a length
splits at most one interval and opens one, so there are at most 3 * capacity
intervals), so it is broadcast. Every piece then takes the slot of its rank
within its length; ranks come from a two-level count, never from one task.

Defined results: a null or empty text is one piece that holds the end token;
repeated rows and null ids are documents of their own; an empty table packs to
nothing; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legwise.llm.byte_tokens import encoder
from legwise.llm.common import cut, release, slices, text_bytes

CAPACITY = 1024
END_ID = 2
#: Text bytes whose pieces are held at a time (a longer text stands alone).
SLICE = 1 << 20
#: Rows aimed at in one (length, bucket) group of the rank window.
GROUP_ROWS = 50_000


def _pieces(path: str, capacity: int, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode = encoder(path).ids
        for batch in batches:
            texts = batch.column("text")
            for first, last in slices(text_bytes(texts)[1], SLICE):
                rows, piece, start, length, cuts = [], [], [], [], []
                for i in range(first, last):
                    ids = encode(texts[i].as_py() or "") + end
                    n = len(ids) // 4
                    lo, hi, k = 0, n % capacity or capacity, 0
                    if n <= capacity:
                        hi = n
                    while lo < n:
                        rows.append(i)
                        piece.append(k)
                        start.append(lo)
                        length.append(hi - lo)
                        cuts.append(ids[4 * lo:4 * hi])
                        lo, hi, k = hi, hi + capacity, k + 1
                keys = batch.select(["doc_id", "row_key"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(cuts, pa.binary())],
                    names=["doc_id", "row_key", "piece", "start", "length", "ids"])
        release()
    return run


def pieces(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, row_key, piece, start, length, ids), written once; ``ids`` holds
    little-endian unsigned 32-bit integers."""
    keyed = df.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row_key"),
                      F.col(text_col).cast("string").alias("text"))
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    return cut(keyed.mapInArrow(_pieces(vocabulary, capacity, end_id),
                                f"doc_id {id_type}, row_key long, piece int, start long, length long, "
                                "ids binary"), "packing-pieces")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs (length, rank_lo, rank_hi, bin,
    offset, per_bin); rank r of a run lies in bin + (r - rank_lo) // per_bin."""
    free: dict[int, list[tuple[int, int]]] = {}
    runs, bins = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = min((r for r, spans in free.items() if spans and r >= length), default=None)
            if room is None:
                room = capacity
                new = -(-left // (capacity // length))
                free.setdefault(room, []).append((bins, bins + new))
                bins += new
            lo, hi = free[room].pop()
            each = room // length
            whole = min(hi - lo, left // each)
            if whole:
                runs.append((length, rank, rank + whole * each, lo, capacity - room, each))
                free.setdefault(room - each * length, []).append((lo, lo + whole))
                rank, left, lo = rank + whole * each, left - whole * each, lo + whole
            if left and lo < hi:
                runs.append((length, rank, rank + left, lo, capacity - room, each))
                free.setdefault(room - left * length, []).append((lo, lo + 1))
                rank, left, lo = rank + left, 0, lo + 1
            if lo < hi:
                free[room].append((lo, hi))
    return runs


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their place: adds sequence_id and offset."""
    spark = found.sparkSession
    histogram = {r["length"]: r["n"] for r in
                 found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = spark.createDataFrame(plan(histogram, capacity) or [(0, 0, 0, 0, 0, 1)],
                                 "length long, lo long, hi long, bin long, at long, per_bin long")
    buckets = max(64, -(-sum(histogram.values()) // GROUP_ROWS))
    narrow = found.select("doc_id", "row_key", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    dealt = narrow.withColumn("bucket", F.pmod(F.xxhash64("row_key", "piece"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inner = Window.partitionBy("length", "bucket").orderBy("row_key", "piece")
    ranked = (dealt.withColumn("nth", F.row_number().over(inner)).join(first, ["length", "bucket"])
              .withColumn("rank", F.col("first") + F.col("nth") - 1))
    slot = F.col("rank") - F.col("lo")
    return (ranked.alias("p").join(F.broadcast(runs).alias("r"),
                                   (F.col("p.length") == F.col("r.length")) & (slot >= 0)
                                   & (F.col("rank") < F.col("hi")))
            .select("doc_id", "row_key", "piece", "start", F.col("p.length").alias("length"), "ids_crc32",
                    (F.col("bin") + F.floor(slot / F.col("per_bin"))).alias("sequence_id"),
                    (F.col("at") + F.pmod(slot, F.col("per_bin")) * F.col("p.length")).alias("offset")))


def best_fit_packing(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset."""
    return pack(pieces(df, vocabulary, id_col, text_col, capacity, end_id), capacity).drop("row_key")


def sequences(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
              capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences: sequence_id, ids (array of ints, ``capacity`` at
    most) and doc_ids, the documents of its pieces in order. Ids meet their places
    in one shuffle; a sequence is a group of at most ``capacity`` pieces."""
    found = pieces(df, vocabulary, id_col, text_col, capacity, end_id)
    placed = pack(found, capacity).select("row_key", "piece", "sequence_id", "offset")
    parts = found.join(placed, ["row_key", "piece"]).groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts"))

    @F.arrow_udf("array<int>")
    def joined(ids: pa.Array) -> pa.Array:
        flat = [b"".join(x) for x in ids.to_pylist()]
        at = np.concatenate([[0], np.cumsum([len(x) // 4 for x in flat], dtype=np.int64)])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(flat), np.int32)))
    return parts.select("sequence_id", joined(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
