"""Operator 12: spelling variant grouping by a variable-length gram index.

Words are counted over whole texts. Two words are near if one inserted, deleted
or replaced code point turns one into the other; a word's form is its most
frequent near word, if that is at least ``RATIO`` times as frequent, and its root
is where following forms ends.

Dictionary. Grams of the words (with a start and an end mark) are counted from
two code points up. A gram is extended while it occurs more than ``threshold``
times, so rare beginnings stay short and common ones grow. The dictionary is the
set of grams to extend; the threshold grows with the words, so that it holds at
most ``DICTIONARY`` grams and can be sent to every task.

Decomposition. From every code point the gram that the dictionary gives, unless
an earlier gram covers it. A gram depends on its own code points alone, so an
edit at place i leaves every gram that ends at or before i, and every gram that
ends more than ``longest`` code points behind i (an earlier, changed gram reaches
no farther): those are its unaffected grams.

Lists. The words of one length and the next form a length group, with the longest
gram allowed chosen so that every edit leaves at least one gram
(2 * longest < length + 3). For each place of an edit a word enters the list of
its rarest unaffected gram only; a near word has the same unaffected grams, at
places that are equal or one apart, so both words meet in that list. All other
lists are skipped. A list is the words with one gram, place and length; a word
meets the list of its own length and those of the next one.

Verification. The words of each met pair are compared exactly; only then copies
of a pair from several lists are removed.

Skew: word counts and gram counts are reduced in the tasks; lists are split by
gram, place and length, and the join on them is split by AQE where one is long.

Defined results: null and empty texts have no words; a null id counts as empty
text in the hash that decides deletions; repeated rows are documents of their
own; ties in n go to the word first in code-point order; an empty table has no
words; no other column is read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwise.llm.common import cut, lower, slices, span_hashes, text_bytes, word_spans

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: One in so many (document, run) hashes deletes a code point.
DELETES = 199
SHORTEST = 2
#: Longest gram of any length group.
LONGEST = 8
#: Most grams in the dictionary that every task holds.
DICTIONARY = 1 << 18
#: Least occurrences from which a gram is extended.
MIN_THRESHOLD = 8
#: Entries that a task holds before it passes them on.
HELD = 1 << 18
#: Longest words that are worked on together.
WIDE = 64
#: Text bytes worked on at a time.
SLICE = 1 << 20
START, END = "\x01", "\x02"


def _crc_table() -> np.ndarray:
    """The byte table of the CRC that zlib has."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_TABLE = _crc_table()


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of bytes, carrying on from the CRC ``begun``."""
    order = np.argsort(starts - ends, kind="stable")  # longest first
    starts, length, crc = starts[order], (ends - starts)[order], ~begun[order]
    counts = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
    for j, n in enumerate(counts):  # the n spans of more than j bytes
        crc[:n] = CRC_TABLE[(crc[:n] ^ data[starts[:n] + j]) & 255] ^ (crc[:n] >> 8)
    out = np.empty_like(crc)
    out[order] = ~crc
    return out


def _runs(data: np.ndarray, at: np.ndarray, begun: np.ndarray, min_length: int) -> pa.RecordBatch:
    """(word, n) of the texts data[at[i]:at[i + 1]], a word perhaps twice;
    ``begun``: CRC of each text's id and colon."""
    low = lower(data)
    lead = low == 0xC3  # in UTF-8 the first byte of U+00C0 to U+00FF, and of nothing else
    letter = (low >= 97) & (low <= 122) | lead
    letter[1:] |= lead[:-1]
    starts, ends = word_spans(~letter, at)
    points = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
    size = points[ends] - points[starts]
    long = size >= min_length
    starts, ends, size = starts[long], ends[long], size[long]
    h = crc32_of_spans(low, starts, ends, begun[np.searchsorted(at, starts, side="right") - 1])
    changed = h % DELETES == 0
    cut_words = []
    for a, b, x, k in zip(starts[changed], ends[changed], h[changed], size[changed]):
        word, place = low[a:b].tobytes().decode(), int(x) % int(k)
        if k > min_length:
            cut_words.append(word[:place] + word[place + 1:])
    starts, ends = starts[~changed], ends[~changed]
    _, first, n = np.unique(span_hashes(low, starts, ends), return_index=True, return_counts=True)
    starts, length = starts[first], (ends - starts)[first]
    bounds = np.concatenate([[0], np.cumsum(length)])
    spelt = low[np.repeat(starts - bounds[:-1], length) + np.arange(bounds[-1])]
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(spelt))
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([words, pa.array(cut_words, pa.string())]),
         pa.array(np.concatenate([n, np.ones(len(cut_words), np.int64)]), pa.int64())], names=["word", "n"])


def _count_words(min_length: int):
    def run(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
            for lo, hi in slices(at, SLICE):
                if at[hi] > at[lo]:
                    yield _runs(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], begun[lo:hi], min_length)
    return run


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    texts = df.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    return (texts.mapInArrow(_count_words(min_length), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def longest_gram(length: int) -> int:
    """Longest gram of the group of words of ``length`` and one more."""
    return max(SHORTEST, min(LONGEST, (length + 2) // 2))


def _count_grams(longest: int):
    """Occurrences of every gram shorter than ``longest``."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for word in batch.column("word"):
                s = START + word.as_py() + END
                for size in range(SHORTEST, longest):
                    held.update([s[p:p + size] for p in range(len(s) - size + 1)])
                if len(held) > HELD:
                    yield _grams(held)
                    held = Counter()
        yield _grams(held)
    return run


def _grams(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"gram": pa.array(held.keys(), pa.string()),
                                       "n": pa.array(held.values(), pa.int64())})


def gram_dictionary(words: DataFrame, limit: int = DICTIONARY) -> frozenset[str]:
    """The grams to extend: those that occur more often than a threshold, at
    most ``limit`` of them. Of P occurrences of grams no more than
    P / threshold can be above the threshold."""
    total = words.agg(F.sum((F.length("word") + 1).cast("long") * (LONGEST - SHORTEST)).alias("p")).first()["p"] or 0
    threshold = max(MIN_THRESHOLD, math.ceil(total / limit))
    common = (words.mapInArrow(_count_grams(LONGEST), "gram string, n long").groupBy("gram")
              .agg(F.sum("n").alias("n")).where(F.col("n") > threshold).select("gram"))
    return frozenset(common.toPandas()["gram"])  # at most `limit` rows


def decompose(word: str, extend: frozenset[str], longest: int) -> list[tuple[int, int, str]]:
    """(start, end, gram) of the word's grams; starts and ends both rise."""
    s = START + word + END
    found, top = [], 0
    for p in range(len(s) - SHORTEST + 1):
        end = p + SHORTEST
        while end - p < longest and end < len(s) and s[p:end] in extend:
            end += 1
        if end > top:
            top = end
            found.append((p, end, s[p:end]))
    return found


def letter_mask(word: str) -> int:
    """Parity of the word's code points in 63 classes: an edit changes two bits
    at most."""
    out = 0
    for c in word:
        out ^= 1 << ord(c) % 63
    return out


def _decompose(extend: frozenset[str], least: int):
    """Entries of every word in its own length group and in that of words one
    shorter."""
    def run(batches):
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], [], []]
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                own, mask, grams, limit = len(word), letter_mask(word), [], 0
                for group in (own, own - 1):
                    if group < least:
                        continue
                    if longest_gram(group) != limit:
                        limit = longest_gram(group)
                        grams = decompose(word, extend, limit)
                    starts, stops, spelt = zip(*grams)
                    for col, value in zip(cols, (group, word, n, mask)):
                        col += [value] * len(grams)
                    for col, values in zip(cols[4:], (starts, stops, spelt)):
                        col += values
            types = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["grp", "word", "n", "mask", "start", "stop", "gram"])
    return run


def _chosen(rows: pa.Table) -> pa.Table:
    """The lists that words enter, from their entries sorted by (grp, word,
    start): for each place i of an edit the rarest gram that it leaves, which is
    the rarest of those that end by i and of those that end behind the reach of a
    change. A word is a row of a matrix."""
    word, grp = rows["word"].combine_chunks(), rows["grp"]
    group, start, stop = (rows[c].to_numpy() for c in ("grp", "start", "stop"))
    code = word.dictionary_encode().indices.to_numpy()
    begins = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (group[1:] != group[:-1])]))
    k = np.diff(np.append(begins, len(code)))
    gram = rows["gram"].combine_chunks().dictionary_encode()
    spelt = np.empty(len(gram.dictionary), np.int64)
    spelt[np.argsort(np.array(gram.dictionary.to_pylist(), object), kind="stable")] = np.arange(len(spelt))
    rank = np.empty(len(code), np.int64)
    rank[np.lexsort((start, spelt[gram.indices.to_numpy()], rows["c"].to_numpy()))] = np.arange(len(code))

    owner = np.repeat(np.arange(len(begins)), k)
    place = np.arange(len(code)) - begins[owner]
    shape = len(begins), int(k.max())
    ends, ranks = np.full(shape, np.iinfo(np.int32).max, np.int64), np.full((shape[0], shape[1] + 1), len(code), np.int64)
    ends[owner, place], ranks[owner, place] = stop, rank
    left = np.concatenate([ranks[:, -1:], np.minimum.accumulate(ranks[:, :-1], axis=1)], axis=1)
    right = np.minimum.accumulate(ranks[:, ::-1], axis=1)[:, ::-1]
    length = pc.utf8_length(word).to_numpy()[begins]
    longest = np.array([longest_gram(int(g)) for g in group[begins]])
    each, used = np.arange(len(begins)), np.zeros(len(code) + 1, bool)
    for i in range(1, int(length.max()) + 2):
        inside = i <= length + 1
        before = left[each, (ends <= i).sum(axis=1)]
        for reach in (i + longest, i + longest - 1):  # replaced or deleted; inserted
            best = np.minimum(before, right[each, (ends <= reach[:, None]).sum(axis=1)])
            used[best[inside]] = True
    return pa.table({"grp": grp, "word": word, "n": rows["n"], "mask": rows["mask"],
                     "len": pa.array(np.repeat(length, k), pa.int32()), "start": rows["start"],
                     "gram": rows["gram"]}).filter(pa.array(used[rank]))


def _choose(batches):
    """Entries of a partition sorted by (grp, word, start), in chunks of whole
    words of one (grp, word); words longer than WIDE stand alone."""
    held: list[pa.RecordBatch] = []

    def work(table: pa.Table):
        words = table["word"].combine_chunks()
        wide = pc.utf8_length(words).to_numpy() > WIDE
        name = words.dictionary_encode().indices.to_numpy()
        group = table["grp"].to_numpy()
        new = (name[1:] != name[:-1]) | (group[1:] != group[:-1])
        cuts = np.flatnonzero(new & (wide[1:] | wide[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(name)]):
            yield from _chosen(table.slice(int(lo), int(hi - lo))).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < HELD:
            continue
        table = pa.Table.from_batches(held)
        words, groups = table["word"].combine_chunks(), table["grp"].to_numpy()
        last = pc.equal(words, words[len(words) - 1]).to_numpy(zero_copy_only=False) & (groups == groups[-1])
        whole = int(np.argmax(last))  # the last word may go on
        if whole:
            yield from work(table.slice(0, whole))
            held = table.slice(whole).to_batches()
    if held:
        yield from work(pa.Table.from_batches(held))


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, limit: int = DICTIONARY) -> DataFrame:
    """(a, na, b, nb): every pair of words that are near, once. ``words`` (word,
    n) is a written table of distinct words."""
    extend = gram_dictionary(words, limit)
    entries = cut(words.mapInArrow(_decompose(extend, min_length),
                                   "grp int, word string, n long, mask long, start int, stop int, gram string"), "variant-grams")
    counts = entries.groupBy("grp", "gram").agg(F.count(F.lit(1)).alias("c"))
    by_word = (entries.join(counts, ["grp", "gram"]).repartition("grp", "word")
               .sortWithinPartitions("grp", "word", "start"))
    lists = cut(by_word.mapInArrow(_choose, "grp int, word string, n long, mask long, len int, start int, gram string"),
                "variant-lists")
    own = F.col("len") == F.col("grp")
    # A word of the group's length meets its own list, and those of the words one longer.
    places = F.array(*[F.struct((F.col("len") + dl).alias("len"), (F.col("start") + dp).alias("start"))
                       for dl, dp in ((0, 0), (1, 0), (1, 1))])
    asks = (lists.where(own).select("grp", "gram", F.col("word").alias("a"), F.col("n").alias("na"),
                                    F.col("mask").alias("ma"), F.explode(places).alias("at"))
            .select("grp", "gram", F.col("at.len").alias("len"), F.col("at.start").alias("start"), "a", "na", "ma",
                    (F.col("at.len") == F.col("grp")).alias("same")))
    met = asks.join(lists.select("grp", "gram", "len", "start", F.col("word").alias("b"), F.col("n").alias("nb"),
                                 F.col("mask").alias("mb")), ["grp", "gram", "len", "start"])
    near = met.where("(NOT same OR a < b) AND bit_count(ma ^ mb) <= 2").where(F.levenshtein("a", "b", 1) == 1)
    return near.select("a", "na", "b", "nb").distinct()


def group_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                   min_count: int = MIN_COUNT, ratio: int = RATIO, limit: int = DICTIONARY) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = cut(count_words(df, id_col, text_col, min_length, min_count), "variant-words")
    pairs = cut(near_pairs(words, min_length, limit), "variant-pairs")
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("other"), F.col("nb").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("other"), F.col("na").alias("m")))
    ).alias("x")).select("x.*")
    best = (both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.first("n").alias("n"),
                                     F.min(F.struct((-F.col("m")).alias("m"), F.col("other"))).alias("top"))
            .withColumn("is_form", -F.col("top.m") >= ratio * F.col("n"))
            .select("word", "n_near", F.when(F.col("is_form"), F.col("top.other")).alias("form"),
                    F.when(F.col("is_form"), -F.col("top.m")).alias("form_n")))
    best = cut(best, "variant-forms")
    roots = best.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # n grows at least `ratio` times from a word to its form, which bounds a chain of forms.
    most = words.agg(F.max("n").alias("n")).first()["n"] or 1
    steps = max(1, math.ceil(math.log(max(2.0, most / max(1, min_count)), max(2, ratio))))
    for _ in range(math.ceil(math.log2(steps + 1))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = cut(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")),
                    "variant-roots")
    return (words.join(best, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
