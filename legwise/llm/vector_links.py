"""Operator 9: near-duplicate vectors by collision-counting projections.

Unit vectors are projected on ``m = width * tables`` random lines. Each line is
cut into windows; ``width`` lines make a table, and two vectors are candidates
if all windows of one table agree. Width grows with the logarithm of the number
of vectors, so that a vector meets about one unrelated vector per table; the
number of tables is calibrated so that a pair at the threshold is met with
probability ``recall`` (closer pairs more often). A candidate pair is counted
on all m lines with windows centred on the query, |p(x) - p(y)| <= CENTRED; if
the count reaches what a pair at the threshold reaches almost surely, its cosine
is verified in double precision, and only pairs of at least ``threshold`` link.

Equal vectors are one class with a size. Pairs are made inside a task, each in
the first table that shows it; what leaves the task is one row per vector with
its number of links and the smallest vector it is joined to there. A cell with
more than ``BLOCK`` vectors is dealt into blocks, and each pair of blocks is a
unit of work of its own; no pair is left out.

Defined results: null or zero vectors and vectors with null or non-finite
components link with nothing and stay; vectors of several lengths are compared
length by length; rows
with a null vec_id have no component id and are kept; rows with one vec_id and
different vectors share a component; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwise.llm.common import components, cut, mix, shuffle_width

THRESHOLD = 0.95
RECALL = 0.95
WINDOW = 2.0
CENTRED = 0.5
BLOCK = 2048
SEED = 20240229
#: Pairs worked on at a time.
PAIRS = 1 << 15


def _same_window(distance: float) -> float:
    """Probability that two points at ``distance`` share a window of a random line."""
    r = WINDOW / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


class Plan:
    """Lines, windows and limits for ``n`` vectors."""

    def __init__(self, n: int, dim: int, threshold: float, recall: float):
        distance = math.sqrt(2 - 2 * threshold)
        near, far = _same_window(distance), _same_window(math.sqrt(2))
        self.width = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)))
        self.tables = math.ceil(math.log(1 - recall) / math.log(1 - near ** self.width))
        m = self.width * self.tables
        rng = np.random.default_rng(SEED)
        self.lines, self.shift = rng.standard_normal((dim, m)), rng.random(m) * WINDOW
        p = math.erf(CENTRED / distance / math.sqrt(2))
        self.least = math.floor(m * p - 4 * math.sqrt(m * p * (1 - p)))
        self.threshold = threshold

    def project(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places on the lines and the cell of each vector in each table."""
        places = unit @ self.lines
        windows = np.floor((places + self.shift) / WINDOW).astype(np.int64).view(np.uint64)
        cells = np.repeat(mix(np.arange(1, self.tables + 1, dtype=np.uint64))[None], len(unit), 0)
        for k in range(self.width):
            cells = mix(cells * np.uint64(0x9E3779B97F4A7C15) + windows[:, k::self.width])
        return places.astype(np.float32), cells.view(np.int64)


def _fingerprints(batches):
    for batch in batches:
        packed, digest, dim = [], [], []
        for v in batch.column("v").to_pylist():
            a = None if v is None or None in v else np.array(v, np.float64)
            if a is not None and np.isfinite(a).all() and a.any():
                packed.append((a + 0.0).tobytes())
                digest.append(hashlib.blake2b(packed[-1], digest_size=16).digest())
                dim.append(len(a))
            else:
                packed.append(None)
                digest.append(None)
                dim.append(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(packed, pa.binary()), pa.array(digest, pa.binary()),
             pa.array(dim, pa.int32())], names=["vec_id", "v", "digest", "dim"])


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    v = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the norm
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _cells(plan: Plan, dim: int):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                cells = plan.project(_unit(part.column("v"), dim))[1]
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array(np.repeat(part.column("node").to_numpy(), plan.tables)),
                     "cell": pa.array(cells.ravel()),
                     "nth": pa.array(np.tile(np.arange(plan.tables, dtype=np.int32), part.num_rows))})
    return run


def _pairs(starts: np.ndarray, ends: np.ndarray, side: np.ndarray, mixed: np.ndarray):
    """Row pairs of each unit of work, some PAIRS at a time: across the blocks
    of a mixed unit, else all."""
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    after = np.arange(len(owner)) + 1
    partners = ends[owner] - after
    total = np.concatenate([[0], np.cumsum(partners)])
    lo = 0
    while lo < len(owner):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PAIRS, side="right")) - 1)
        i = np.repeat(np.arange(lo, hi), partners[lo:hi])
        j = i + 1 + np.arange(len(i)) - np.repeat(total[lo:hi] - total[lo], partners[lo:hi])
        keep = ~mixed[owner[i]] | (side[i] != side[j])
        yield i[keep], j[keep]
        lo = hi


def _links(plan: Plan, dim: int):
    shape = ["cell", "nth", "b1", "b2", "side", "node", "size", "v"]

    def work(rows: pa.Table):
        unit_key = np.stack([rows[c].to_numpy() for c in ("cell", "b1", "b2")])
        starts = np.concatenate([[0], np.flatnonzero((unit_key[:, 1:] != unit_key[:, :-1]).any(axis=0)) + 1])
        ends = np.append(starts[1:], rows.num_rows)
        side, nth, node, size = (rows[c].to_numpy() for c in ("side", "nth", "node", "size"))
        unit = _unit(rows["v"], dim)
        places, cells = plan.project(unit)
        links, root = np.zeros(rows.num_rows, np.int64), node.copy()
        hit_i, hit_j = [], []
        for i, j in _pairs(starts, ends, side, unit_key[1, starts] != unit_key[2, starts]):
            first = (cells[i] == cells[j]).argmax(axis=1) == nth[i]
            i, j = i[first], j[first]
            near = (np.abs(places[i] - places[j]) <= CENTRED).sum(axis=1) >= plan.least
            i, j = i[near], j[near]
            linked = np.einsum("ij,ij->i", unit[i], unit[j]) >= plan.threshold
            i, j = i[linked], j[linked]
            np.add.at(links, i, size[j])
            np.add.at(links, j, size[i])
            hit_i.append(i)
            hit_j.append(j)
        i, j = np.concatenate(hit_i or [np.zeros(0, int)]), np.concatenate(hit_j or [np.zeros(0, int)])
        while len(i):  # the smallest node joined within each unit of work
            low = np.minimum(root[i], root[j])
            if (low == root[i]).all() and (low == root[j]).all():
                break
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
        some = links > 0
        return pa.RecordBatch.from_pydict({"node": pa.array(node[some]), "links": pa.array(links[some]),
                                           "root": pa.array(root[some])})

    def run(batches):
        held = None
        for batch in batches:
            held = pa.concat_tables([*([held] if held is not None else []),
                                     pa.Table.from_batches([batch.select(shape)])])
            last = held.num_rows
            key = [held[c].to_numpy() for c in ("cell", "b1", "b2")]
            same = np.logical_and.reduce([k == k[-1] for k in key]) if last else np.zeros(0, bool)
            cutoff = int(np.argmax(same)) if last else 0  # the last unit may go on
            if cutoff:
                yield work(held.slice(0, cutoff).combine_chunks())
                held = held.slice(cutoff)
        if held is not None and held.num_rows:
            yield work(held.combine_chunks())
    return run


def vector_components(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                      threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    spark = df.sparkSession
    raw = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = cut(raw.mapInArrow(_fingerprints, "vec_id long, v binary, digest binary, dim int"), "vector-rows")
    classes = cut(rows.where("dim > 0").groupBy("dim", "digest").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("v").alias("v"))
        .withColumn("node", F.coalesce("rep", F.xxhash64("digest"))), "vector-classes")
    lengths = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("dim").collect()
    # (node, links, root) of every length; vectors of different lengths never link
    found = spark.createDataFrame([], "node long, links long, root long")
    for r in lengths:
        found = found.unionByName(_links_of_length(classes.where(F.col("dim") == r["dim"]),
                                                   Plan(r["n"], r["dim"], threshold, recall), r["dim"]))

    comps = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    home = cut(classes.join(totals, "node", "left").join(comps, "node", "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id")), "vector-home")
    alone = rows.where("dim = 0").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                         F.col("vec_id").alias("component_id"))
    return (rows.where("dim > 0").select("vec_id", "digest").join(home, "digest")
            .select("vec_id", "n_links", "component_id").unionByName(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def _links_of_length(classes: DataFrame, plan: Plan, dim: int) -> DataFrame:
    """(node, links, root) of the classes of one vector length."""
    spark = classes.sparkSession
    cells = cut(classes.select("node", "v").mapInArrow(_cells(plan, dim), "node long, cell long, nth int"),
                "vector-cells")
    shared = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    dealt = (cells.join(shared, "cell").withColumn("blocks", F.ceil(F.col("c") / BLOCK))
             .withColumn("side", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
             .select("node", "cell", "nth", "side", F.least("side", "other").alias("b1"),
                     F.greatest("side", "other").alias("b2")))
    units = (dealt.join(classes.select("node", "size", "v"), "node")
             .repartition(shuffle_width(spark), "cell", "b1", "b2").sortWithinPartitions("cell", "b1", "b2"))
    return cut(units.mapInArrow(_links(plan, dim), "node long, links long, root long"), "vector-links")
