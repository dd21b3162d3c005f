"""What an operator holds or moves at a time stays bounded."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from legwise.llm import packing, shingle_join


def test_pieces_are_given_in_small_batches():
    texts = [f"text {i} " * 40_000 for i in range(12)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(14)), "row_key": list(range(14)), "text": texts})
    out = list(packing._pieces(public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)([batch]))
    longest = max(len(t or "") for t in texts)
    assert max(sum(b.column("length").to_pylist()) for b in out) <= 2 * max(packing.SLICE, longest) and len(out) > 2
    assert sorted({d for b in out for d in b.column("doc_id").to_pylist()}) == list(range(14))
    for b in out:
        assert [len(x) // 4 for x in b.column("ids").to_pylist()] == b.column("length").to_pylist()


def test_links_go_through_the_rounds_once(spark, monkeypatch):
    words = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join("other" if i == 2 * k else w for i, w in enumerate(words))) for k in range(40)]
    given, whole = [], shingle_join.components

    def counted(edges, *args):
        given.append(edges.count())
        return whole(edges, *args)
    monkeypatch.setattr(shingle_join, "components", counted)
    got = shingle_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 40
    assert sum(given) < 2 * len(rows)


def test_a_large_group_of_few_links_is_not_asked_in_all_pairs(spark):
    """Every eighth pair of one list links, so pivots leave most sets outside."""
    count, asked = 400, []

    class Answers:
        def verify(self, pairs):
            rows = [(r.a, r.b, 100, 100, 87 if hash((r.a, r.b)) % 8 == 0 else 84) for r in pairs.collect()]
            asked.append(len(rows))
            return spark.createDataFrame(rows, "a long, b long, na long, nb long, o long")
    lists = spark.createDataFrame([(1, k, 100, 0) for k in range(count)], "h long, node long, n long, i int")
    got = shingle_join.set_components(lists, Answers()).collect()
    assert {r.root for r in got} == {0} and len(got) == count
    assert sum(asked) < 100 * count, asked


def test_common_shingles_come_after_the_rare_ones(spark, monkeypatch):
    """A shingle that is common, though not among the very frequent ones of a
    large table, is no part of a prefix of rare ones, so that no list grows with it."""
    seen = []
    rows = []
    for k in range(1500):
        words = [f"o{k}-{i}" for i in range(600)]
        for j, at in enumerate((100, 300, 500)):
            words[at:at + 5] = [f"c{(k + 250 * j) % 750}-{i}" for i in range(5)]
        rows.append((k, " ".join(words)))

    def watched(lists, sets):
        seen.append(lists.count())
        return spark.createDataFrame([], "node long, root long")
    monkeypatch.setattr(shingle_join, "set_components", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert shingle_join.jaccard_components(df).count() == len(rows)
    assert seen == [0]


def test_shingles_repeated_less_than_chance_come_late(spark, monkeypatch):
    """Thirty sets share a passage, in buckets of about 170 other shingles: too few to stand out from chance, but a
    prefix has rarer ones to take, so that few of its sets meet."""
    seen = []
    rows = []
    for k in range(300):
        words = [f"o{k}-{i}" for i in range(600)]
        words[200:260] = [f"c{k % 10}-{i}" for i in range(60)]
        rows.append((k, " ".join(words)))

    def watched(lists, sets):
        seen.append(lists.count())
        return spark.createDataFrame([], "node long, root long")
    monkeypatch.setattr(shingle_join, "set_components", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert shingle_join.jaccard_components(df, buckets=1 << 10).count() == len(rows)
    assert seen[0] < 0.03 * 56 * len(rows), seen


def test_levels_follow_the_counts(spark):
    """Fuller buckets have higher levels, and all levels fit the keys."""
    rows = [(" ".join(f"w{j % 97 * (j % 3)}-{j * (j % 5)}" for j in range(5000)),), ("a b c d e " * 30000,)]
    texts = spark.createDataFrame(rows, "text string")
    levels = shingle_join.bucket_levels(texts, 64)
    counts = np.zeros(64, np.int64)
    for text, in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        _, h = shingle_join.shingle_hashes(data, np.array([0, len(data)]))
        np.add.at(counts, shingle_join._bucket(h, 64), 1)
    assert (np.diff(levels[np.argsort(counts)].astype(int)) >= 0).all()
    assert levels.max() < shingle_join.LEVELS and levels.max() << shingle_join.KEY_BITS < 1 << 63 and len(set(levels)) > 5


def test_sparse_lists_are_compared_at_once(spark):
    """Sets that meet few others need no rounds: every meeting pair is asked once."""
    count, asked = 60, []

    class Answers:
        def verify(self, pairs):
            found = sorted((r.a, r.b) for r in pairs.collect())
            asked.append(found)
            return spark.createDataFrame([(a, b, 100, 100, 90) for a, b in found], "a long, b long, na long, nb long, o long")
    rows = [(h, h + j, 100, j) for h in range(count) for j in range(2)] + [(-1 - k, k, 100, 20) for k in range(count)]
    lists = spark.createDataFrame(rows, "h long, node long, n long, i int")
    got = shingle_join.set_components(lists, Answers()).collect()
    assert asked == [[(k, k + 1) for k in range(count)]]
    assert {r.node: r.root for r in got} == {k: 0 for k in range(count + 1)}
