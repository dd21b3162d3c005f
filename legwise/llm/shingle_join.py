"""Operator 4: n-gram Jaccard join by set-relation skipping.

Documents with equal shingle sets form one class first, so copies are reduced
before anything else. The global order of shingles is by level, then by hash. All
shingles are counted in a fixed number of buckets; a bucket's level says how far
its count is below or above what most buckets hold, so that prefixes take the
shingles of the emptiest buckets, which repeated ones seldom are in, and shingles
more frequent than chance come last, in steps of their frequency. An index list
holds the sets whose prefix contains a shingle, with set size and position.

Index-level skipping: an entry at position i of a set of n shingles can only
meet partners of at most (4n - 7i) / 3 shingles. Entries with 7i <= n form the
front block of a list; two entries of the rear block never meet, so a list
without front entries is skipped whole.

Answer-level skipping: every list has a pivot, and in each round a set is
compared with one pivot only, the one it meets in most lists. Sets that turn out
in one component need no comparison with each other, and a set takes over what is
known of the pivot: with Jaccard distances d(x, p) and d(y, p) more than 0.25
apart, x and y cannot link. Only what these rules leave open is compared pair by
pair. The answer is the classes' components, which no skipped pair can change.

Signatures: a set's shingles also set parities of SIGNATURE bits, those of a long
set of more bits as well. Two sets differ
in at least as many shingles as their signatures do in bits, and linked sets
differ in a seventh of their sizes' sum at most, so pairs of sets that differ more
are out before any list of shingles is moved.

Skew: classes, pivots and list statistics are aggregations with a map-side
part; joins on lists and pivots are split by AQE. Nothing is collected but the
fixed number of buckets.

Defined results: null or empty texts and texts without words have no shingles
and are their own component; rows with one doc_id are one document, so they
share a component; rows with a null doc_id get the smallest doc_id of their
component, or null; empty tables give empty results; other columns are not
read. Shingles are compared by 64-bit hashes, sets by a 64-bit digest and size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.llm.common import (components, cut, lower, mix, powers, release, shuffle_width, slices, text_bytes,
                                word_hashes)

WIDTH = 5
#: Buckets in which shingles are counted, and how many of them one row moves.
BUCKETS, CHUNK = 1 << 21, 1 << 15
#: Levels of buckets: first these steps of chance about the usual count. Lists of levels from HOT on are kept without
#: a look.
CHANCE = (-2, -1.5, -1, -0.5, 0, 0.5, 1, 1.5, 2, 3)
LEVELS, HOT = 32, 19
#: Text bytes worked on at a time (a longer text stands alone).
SLICE = 1 << 19
#: Rounds in which every set asks one pivot, and about how many sets of each list it asks in the round after them.
PIVOT_ROUNDS, SOME = 2, 64
#: Meetings an entry of the lists, up to which the sets are compared without pivots.
SPARSE = 4
#: Bits of a signature; sets of more shingles than the first numbers have one of as many more bits.
SIGNATURE, WIDE = 512, ((2400, 8192), (600, 2048))
#: Pairs up to which their nodes are broadcast (at most 64 bytes a pair).
BROADCAST_ROWS = 400_000
#: Bits of a key below its level.
KEY_BITS = 58
#: Entries of a list this far apart are compared before the list is kept.
NEAR = 8

def shingle_hashes(data: np.ndarray, at: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of every shingle of the texts data[at[i]:at[i+1]]."""
    low = lower(data)
    doc, words = word_hashes(low, (low == 32) | ((low >= 9) & (low <= 13)), at)
    if not len(words):
        return doc, words
    factor = powers(0xBF58476D1CE4E5B9, width + 1)[1:]
    n = len(words)
    docs, hashes = [], []
    if n >= width:
        total = sum(words[j:n - width + 1 + j] * factor[j] for j in range(width))
        inside = doc[width - 1:] == doc[:n - width + 1]
        docs.append(doc[:n - width + 1][inside])
        hashes.append(total[inside])
    short, first, count = np.unique(doc, return_index=True, return_counts=True)
    for k in range(1, width):  # whole sequences of k words
        lot = first[count == k]
        if len(lot):
            docs.append(short[count == k])
            hashes.append(sum(words[lot + j] * factor[j] for j in range(k)) + np.uint64(k))
    return np.concatenate(docs), mix(np.concatenate(hashes))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _wider(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // count}").astype(np.int64)


def _counted(buckets: int, chunk: int):
    """Shingles of a task by bucket, as rows of ``chunk`` buckets."""
    def run(batches):
        counts = np.zeros(buckets, np.uint32)
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            for lo, hi in slices(at, SLICE):
                _, h = shingle_hashes(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
                np.add.at(counts, _bucket(h, buckets), np.uint32(1))
        parts = counts.reshape(-1, chunk)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_pydict({"part": pa.array(some, pa.int32()),
                                          "counts": pa.array([_narrow(parts[i]) for i in some], pa.binary())})
        release()
    return run


def _summed(chunk: int):
    def run(rows: pa.Table) -> pa.Table:
        total = np.zeros(chunk, np.int64)
        for data in rows["counts"]:
            total += _wider(data.as_py(), chunk)
        return pa.table({"part": rows["part"].slice(0, 1), "counts": pa.array([_narrow(total)], pa.binary())})
    return run


def bucket_levels(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The level of every bucket of shingles: by its standard deviations from the
    usual count up to what chance adds to it, then two for each doubling of what
    is above. A shingle that repeats lifts its own bucket, so that the level tells
    it from rare ones long before it stands out from chance."""
    chunk, schema = min(CHUNK, buckets), "part int, counts binary"
    counts = np.zeros((buckets // chunk, chunk), np.int64)
    for row in (texts.mapInArrow(_counted(buckets, chunk), schema).groupBy("part")
                .applyInArrow(_summed(chunk), schema).collect()):  # a fixed number of rows
        counts[row["part"]] = _wider(row["counts"], chunk)
    usual = float(np.median(counts))
    over = counts.ravel() - usual
    chance = np.searchsorted(CHANCE, over / max(usual, 1) ** 0.5, side="right")
    above = over / (4 * usual ** 0.5 + 4)
    steps = len(CHANCE) + 1 + np.floor(2 * np.log2(np.maximum(above, 1)))
    return np.where(above > 1, np.minimum(steps, LEVELS - 1), chance).astype(np.uint8)


def _ordered(data, at, levels: np.ndarray):
    """Distinct shingle keys of each text in the global order: keys, bounds."""
    doc, h = shingle_hashes(data, at)
    key = h & np.uint64((1 << KEY_BITS) - 1) | levels[_bucket(h, len(levels))].astype(np.uint64) << np.uint64(KEY_BITS)
    order = np.argsort(key)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(at) < 1 << 16 else np.int64), kind="stable")]
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    doc, key = doc[new], key[new]
    return key.view(np.int64), np.searchsorted(doc, np.arange(len(at)))


def signatures(keys: np.ndarray, bounds: np.ndarray, bits: int = SIGNATURE) -> np.ndarray:
    """(sets, bits / 64) parities of the keys[bounds[i]:bounds[i + 1]]."""
    width = bits // 64
    out = np.zeros((len(bounds) - 1) * width, np.uint64)
    bit = mix(keys.view(np.uint64)) >> np.uint64(64 - bits.bit_length() + 1)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    np.bitwise_xor.at(out, owner * width + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.view(np.int64)


def _wide(keys: np.ndarray, bounds: np.ndarray, n: np.ndarray) -> pa.Array:
    """Wide signatures of the long sets, null for the others."""
    out, above = [None] * len(n), np.iinfo(np.int64).max
    for least, bits in WIDE:
        some = np.flatnonzero((n > least) & (n <= above))
        above = least
        if len(some):
            own = np.concatenate([keys[bounds[i]:bounds[i + 1]] for i in some])
            made = signatures(own, np.concatenate([[0], np.cumsum(n[some])]), bits).reshape(len(some), -1)
            for i, row in zip(some, made):
                out[i] = row
    return pa.array(out, pa.list_(pa.int64()))


def _sets(levels: np.ndarray, whole: bool):
    """One row per text: its other columns, set digest, size and keys: all of
    them, or the prefix alone and the signature of all."""
    def run(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            others = batch.drop_columns(["text"])
            for lo, hi in slices(at, SLICE):
                keys, bounds = _ordered(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], levels)
                n = np.diff(bounds)
                digest = [int.from_bytes(hashlib.blake2b(keys[a:b], digest_size=8).digest(), "little", signed=True)
                          for a, b in zip(bounds[:-1], bounds[1:])]
                part = others.slice(lo, hi - lo)
                columns = [*part.columns, pa.array(digest, pa.int64()), pa.array(n, pa.int64())]
                names = [*part.schema.names, "digest", "n"]
                if not whole:
                    width = SIGNATURE // 64
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.arange(0, (hi - lo) * width + 1, width), pa.int32()), pa.array(signatures(keys, bounds))))
                    columns.append(_wide(keys, bounds, n))
                    names += ["sig", "wide"]
                    take = np.where(n > 0, n - (3 * n + 3) // 4 + 1, 0)
                    cuts = np.concatenate([[0], np.cumsum(take)])
                    keys = keys[np.repeat(bounds[:-1] - cuts[:-1], take) + np.arange(cuts[-1])]
                else:
                    cuts = bounds
                columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(keys)))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "keys"])
        release()
    return run


def _met(rows: pa.Table) -> pa.RecordBatch:
    """The entries that can meet another one of their list. Entries up to NEAR
    places apart are compared; longer lists are kept whole."""
    h, n, i = (rows[c].to_numpy() for c in ("h", "n", "i"))
    reach, keep = 4 * n - 7 * i.astype(np.int64), np.zeros(len(h), bool)
    for s in range(1, min(NEAR, len(h) - 1) + 1):
        meet = (h[s:] == h[:-s]) & (3 * n[s:] <= reach[:-s]) & (3 * n[:-s] <= reach[s:])
        keep[s:] |= meet
        keep[:-s] |= meet
    if len(h) > NEAR:
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        length = np.diff(np.append(start, len(h)))
        keep |= np.repeat(length > NEAR + 1, length)
    return rows.filter(pa.array(keep)).combine_chunks()


def _meeting(batches):
    """Streams entries sorted by h; a list may span batches."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        h = held["h"].to_numpy()
        whole = int(np.searchsorted(h, h[-1])) if len(h) else 0
        if whole:
            yield from _met(held.slice(0, whole)).to_batches()
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield from _met(held).to_batches()
    held = None
    release()


def _in_lists(entries: DataFrame) -> DataFrame:
    """Entries of lists in which some entry can meet another one. Lists of
    the high levels need no look, so they are not gathered; the others are as
    short as the counts of their buckets."""
    spark = entries.sparkSession
    rare = (entries.where(F.col("h") < HOT << KEY_BITS).repartition(shuffle_width(spark), "h").sortWithinPartitions("h")
            .mapInArrow(_meeting, entries.schema))
    return rare.unionByName(entries.where(F.col("h") >= HOT << KEY_BITS))


def _alike(x: str, y: str, n: str) -> Column:
    """Whether two sets, of ``n`` shingles together, may link by their
    signatures; ``x`` and ``y`` begin the names of their columns. Wide signatures
    are compared if they are of one width."""
    bits = [F.bit_count(F.col(f"{x}sig")[i].bitwiseXOR(F.col(f"{y}sig")[i])) for i in range(SIGNATURE // 64)]
    wide = F.aggregate(F.zip_with(f"{x}wide", f"{y}wide", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0),
                       lambda total, one: total + one)
    return (7 * sum(bits[1:], bits[0]) <= F.expr(n)) & F.coalesce(7 * wide <= F.expr(n), F.lit(True))


def _sides(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with sizes and keys of both sets."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("keys").alias("ka"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("keys").alias("kb"))
    return pairs.join(left, "a").join(right, "b")


class _Sets:
    """The sets of the classes: ``heads`` (node, n, keys of the prefix, digest,
    rep) is written, whole sets are read from the texts when asked for."""

    def __init__(self, texts: DataFrame, heads: DataFrame, levels: np.ndarray):
        self.texts, self.heads, self.levels = texts, heads, levels

    def of(self, nodes: DataFrame, small: bool) -> DataFrame:
        """The whole sets of ``nodes``, read from their texts."""
        wanted = self.heads.join(_marked(nodes, small), "node", "left_semi").select(
            F.col("rep").alias("r"), "node", F.col("digest").alias("d"), F.col("n").alias("m"))
        return (self.texts.join(_marked(wanted, small), F.col("doc_id").eqNullSafe(F.col("r")))
                .select("text", "node", "d", "m")
                .mapInArrow(_sets(self.levels, whole=True),
                            "node long, d long, m long, digest long, n long, keys array<long>")
                .where("digest = d AND n = m").select("node", "n", "keys"))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with set sizes na, nb and the size o of the intersection.
        Pairs whose signatures or prefixes already rule out a link are left out: up
        to the last key both prefixes cover, the common shingles are known exactly.
        Only what the pairs need of a set is moved: their nodes are broadcast where
        the counted pairs are few enough, those asked and those that signatures leave."""
        asked = cut(pairs, "shingle-asked")
        small = _few(asked)
        one, two = (self.heads.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("sig").alias(f"{k}sig"),
                                      F.col("wide").alias(f"{k}wide")).join(_marked(asked.select(k), small), k, "left_semi")
                    for k in ("a", "b"))
        alike = cut(asked.join(one, "a").join(two, "b").where(_alike("a", "b", "na + nb")).select("a", "b"), "shingle-alike")
        small = small or _few(alike)
        near = self.heads.join(_marked(_nodes(alike), small), "node", "left_semi").select("node", "n", "keys")
        bound = (_sides(alike, near)
                 .withColumn("upto", F.least(F.element_at("ka", -1), F.element_at("kb", -1)))
                 .withColumn("most", F.size(F.array_intersect("ka", "kb")) + F.least(
                     F.col("na") - F.size(F.filter("ka", lambda k: k <= F.col("upto"))),
                     F.col("nb") - F.size(F.filter("kb", lambda k: k <= F.col("upto"))))))
        likely = cut(bound.where("7 * most >= 3 * (na + nb)").select("a", "b"), "shingle-likely")
        sets = cut(self.of(_nodes(likely), small), "shingle-sets")
        return cut(_sides(likely, sets).select(
            "a", "b", "na", "nb", F.size(F.array_intersect("ka", "kb")).cast("long").alias("o")), "shingle-checked")


def _few(pairs: DataFrame) -> bool:
    return pairs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _marked(df: DataFrame, small: bool) -> DataFrame:
    """A narrow table, for broadcast if its rows have been counted as few."""
    return F.broadcast(df) if small else df


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _linked(checked: DataFrame) -> DataFrame:
    return checked.where("100 * o >= 75 * (na + nb - o)").select("a", "b")


def _meet(n1: str, i1: str, n2: str, i2: str):
    """Length and position filter of two entries of one list."""
    return F.expr(f"3 * {n2} <= 4 * {n1} - 7 * {i1} AND 3 * {n1} <= 4 * {n2} - 7 * {i2}")


def _merged(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, root) with further links (a, b). Only the roots that
    links join anew take part, so that no link goes through the rounds twice."""
    if comps is None:
        return components(links, "shingle-components")
    if links.isEmpty():
        return comps
    one, two = (comps.select(F.col("node").alias(k), F.col("root").alias(f"r{k}")) for k in ("a", "b"))
    anew = links.join(one, "a", "left").join(two, "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b")
    tops = components(anew, "shingle-components")
    moved = comps.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select(
        "node", F.coalesce("top", "root").alias("root"))
    return cut(moved.unionByName(tops.join(comps, "node", "left_anti")), "shingle-components")


def _with_component(entries: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Entries of lists that still hold several components, with the list's
    component of most entries (``big``) and its number of entries."""
    if comps is None:
        return entries.withColumn("comp", F.col("node")).withColumn("big", F.lit(None).cast("long"))
    known = entries.join(comps, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    known = cut(known, "shingle-lists")
    big = (known.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
           .groupBy("h").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("entries"),
                             F.count(F.lit(1)).alias("kinds"))
           .where("kinds > 1").select("h", F.col("top.comp").alias("big"), "entries"))
    return known.join(big, "h")


def _pair(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _sparse(lists: DataFrame) -> bool:
    """Whether the lists are so short that their entries meet few others. An
    entry of the front block meets its list at most, and no others meet."""
    size = lists.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.count(F.when(F.expr("7 * i <= n"), 1)).alias("front"))
    total = size.agg(F.sum("c").alias("entries"), F.sum(F.expr("c * front")).alias("meetings")).first()
    return (total["meetings"] or 0) <= SPARSE * (total["entries"] or 0)


def set_components(lists: DataFrame, sets: _Sets) -> DataFrame:
    """Components (node, root) of all links between nodes.
    lists: (h, node, n, i)."""
    if _sparse(lists):
        x, y = lists.alias("x"), lists.alias("y")
        pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & F.expr("x.node < y.node") & _meet("x.n", "x.i", "y.n", "y.i"))
        return _merged(None, _linked(sets.verify(pairs.select(*_pair("x.node", "y.node")).distinct())))
    comps = checked = None
    for turn in range(PIVOT_ROUNDS):
        open_lists = _with_component(lists, comps)
        # A new pivot each round: of a list's component of most entries, which its other sets ask, or of the others.
        later = F.coalesce(F.col("comp") == F.col("big"), F.lit(False)) != F.lit(turn % 2 == 1)
        pivot = (open_lists.groupBy("h").agg(F.min(F.when(F.expr("7 * i <= n"), F.struct(
            later.alias("l"), F.xxhash64("node", F.lit(turn)).alias("r"), F.col("node").alias("p"), F.col("n").alias("pn"),
            F.col("i").alias("pi"), F.col("comp").alias("pc")))).alias("pivot"))
            .where("pivot IS NOT NULL").select("h", "pivot.p", "pivot.pn", "pivot.pi", "pivot.pc"))
        met = (open_lists.join(pivot, "h").where("comp <> pc").where(_meet("n", "i", "pn", "pi"))
               .groupBy("node", "p").agg(F.count(F.lit(1)).alias("c")))
        if checked is not None:  # an answer that is known is not asked for again
            known = checked.select("a", "b").unionByName(checked.select(F.col("b").alias("a"), F.col("a").alias("b")))
            met = met.join(known.select(F.col("a").alias("node"), F.col("b").alias("p")), ["node", "p"], "left_anti")
        asked = (met.groupBy("node").agg(F.max(F.struct("c", F.xxhash64("p").alias("r"), "p")).alias("top"))
                 .select("node", "top.p").select(*_pair("node", "p")).distinct())
        found = sets.verify(asked)
        checked = found if checked is None else checked.unionByName(found)
        comps = _merged(comps, _linked(found))

    # Few sets of a large group may link to its pivots: those still outside first ask some of each list, so that what
    # joins then does not meet the whole group.
    found = sets.verify(_open_pairs(lists, comps, checked, SOME))
    checked = checked.unionByName(found)
    comps = _merged(comps, _linked(found))
    return _merged(comps, _linked(sets.verify(_open_pairs(lists, comps, checked))))


def _open_pairs(lists: DataFrame, comps: DataFrame, checked: DataFrame, some: int | None = None) -> DataFrame:
    """Pairs (a, b) of sets of different components that share a list and have not been checked, unless a pivot's
    answers rule them out; with ``some``, only those with about so many sets of each list. A set meets another in
    many lists, so signatures move with the distinct pairs (in verify), not with the entries."""
    gap = F.expr("1 - o / (na + nb - o)")
    both = checked.unionByName(checked.select(F.col("b").alias("a"), F.col("a").alias("b"),
                                              F.col("nb").alias("na"), F.col("na").alias("nb"), "o"))
    # The closest pivot that a set has been compared with tells most about it.
    near = (both.groupBy("a").agg(F.min(F.struct(gap.alias("d"), F.col("b").alias("q"))).alias("top"))
            .select(F.col("a").alias("node"), "top.d", "top.q"))
    open_lists = cut(_with_component(lists, comps).join(near, "node", "left"), "shingle-open")
    x, y = open_lists.where("comp <> big").alias("x"), open_lists.alias("y")
    if some is not None:  # the same sets of every list, as far as lists are alike
        y = open_lists.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) * F.col("entries") < some * (1 << 30)).alias("y")
    return (x.join(y, (F.col("x.h") == F.col("y.h")) & F.expr(
        "x.comp <> y.comp AND (y.comp = y.big OR x.node < y.node)"
        " AND NOT coalesce(x.q = y.q AND abs(x.d - y.d) > 0.250001, false)") & _meet("x.n", "x.i", "y.n", "y.i"))
        .select(*_pair("x.node", "y.node")).distinct().join(checked, ["a", "b"], "left_anti"))


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    levels = bucket_levels(texts.select("text"), buckets)
    made = texts.mapInArrow(_sets(levels, whole=False), "doc_id long, digest long, n long, sig array<long>, wide array<long>, "
                            "keys array<long>")
    rows = cut(made.select("doc_id", "digest", "n"), "shingle-rows")
    # Copies are reduced in each task before the prefixes move.
    heads = cut(made.where("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("rep"),
                                                              F.first("sig").alias("sig"),
                                                              F.first("wide").alias("wide"),
                                                              F.first("keys").alias("keys"))
                .withColumn("node", F.coalesce("rep", "digest")), "shingle-heads")
    lists = cut(_in_lists(heads.select("node", "n", F.posexplode("keys").alias("i", "h"))), "shingle-lists")
    if rows.groupBy("doc_id", "digest", "n").count().where("count > 1").limit(1).count():
        texts = texts.dropDuplicates()  # repeated rows
    sets = _Sets(texts, heads, levels)
    comps = set_components(lists, sets)
    home = cut(heads.select("digest", "n", "node", "rep").join(comps, "node", "left")
               .select("digest", "n", F.coalesce("root", "rep").alias("component_id")), "shingle-home")
    return (rows.select("doc_id", "digest", "n").join(home, ["digest", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
