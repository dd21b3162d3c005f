"""The llm operators against brute-force versions on small fixtures."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from legwise.llm import language_id, license_scan, packing, shingle_join, token_counts, vector_links
from legwise.llm.byte_tokens import encoder

DOCS = "doc_id long, text string, lang string, source string, text_ string"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def words_of(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def fixture():
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "x " * 30000), (None, "a b c d e f")]
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    for i in range(10, 60):
        words = list(base) if i % 2 else [f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))]
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words)))
    rows += [(90, rows[-1][1]), (91, rows[-1][1]), (91, rows[-1][1])]
    return [(d, t, "en", None, "clash") for d, t in rows]


def test_shingle_join_equals_brute_force(spark):
    rows = fixture()
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in shingle_join.jaccard_components(
        spark.createDataFrame(rows, DOCS)).collect())
    sets = []
    for _, text, *_ in rows:
        w = words_of(text, r"[^\x20\x09-\x0D]+")
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    comp = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b) or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    small = {}
    for c, r in zip(comp, rows):
        if r[0] is not None:
            small[c] = min(small.get(c, r[0]), r[0])
    assert got == sorted((r[0] or -1, len(s), small.get(c)) for r, s, c in zip(rows, sets, comp))


def test_shingle_join_of_nothing(spark):
    assert shingle_join.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0


def test_language_held_out_and_rejects(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs.where("doc_id % 2 = 0"))
    found = language_id.identify(docs.where("doc_id % 2 = 1"), model, host=F.col("source"))
    n, right = found.agg(F.count("*"), F.sum((F.col("language") == F.col("row.lang")).cast("int"))).first()
    assert right >= 0.98 * n
    odd = spark.createDataFrame([(1, None, None, None, ""), (2, "", "en", "src0", ""), (3, "12 34", "de", "x", ""),
                                 (4, "zqxjv kwqzx vvkqj xzqwk " * 9, "en", "src0", "")], DOCS)
    rows = language_id.identify(odd, model, host=F.col("source"), declared=F.col("lang")).collect()
    assert [(r.language, r.accepted) for r in rows] == [("und", False)] * 4


def test_every_label_is_a_language(spark):
    rng, rows = random.Random(8), []
    for k in range(90):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        rows += [(len(rows), " ".join(rng.choices(words, k=40)), f"l{k:02}", f"s{k}", "") for _ in range(3 if k < 70 else 2)]
    docs = spark.createDataFrame(rows, DOCS)
    found = language_id.identify_documents(docs).collect()
    assert len(found) == len(rows) and all(r.language == r.row.lang and r.accepted for r in found)
    with pytest.raises(ValueError, match="more than 89 labels"):
        language_id.fit(docs, max_languages=89)


def test_suffix_and_markup_are_evidence(spark):
    said = {"de": "der hund und die katze", "fr": "le chien avec un chat"}
    rows = [(f"http://h{i}.{x}/", f"<html lang={x}>", t, x) for x, t in said.items() for i in range(20)]
    both = "der hund le chien " * 3  # of either language
    odd = [("http://new.de/a", "", both, None), ("http://new.fr/b", "", both, None),
           ("http://c.org/", '<html lang="de">', both, None), ("http://d.org/", "<html lang='fr-FR'>", both, None)]
    pages = spark.createDataFrame(rows + odd, "url string, html string, text string, lang string")
    found = language_id.identify(pages, language_id.fit(pages), min_confidence=0.0, **language_id.page_evidence())
    got = {r.row.url: (r.language, r.confidence) for r in found.collect()}
    plain = {r.row.url: r.confidence if r.language == "de" else 1 - r.confidence for r in language_id.identify(
        pages, language_id.fit(pages), min_confidence=0.0).collect()}
    towards = {u: c if x == "de" else 1 - c for u, (x, c) in got.items()}
    assert towards["http://new.de/a"] > plain["http://new.de/a"] and towards["http://new.fr/b"] < plain["http://new.fr/b"]
    assert towards["http://c.org/"] > towards["http://d.org/"]


def test_license_places_equal_brute_force(spark):
    rows = [(1, None), (2, ""), (3, "CC-BY cc by, General\nPublic. LICENSE é all rights reserved All Rights"),
            (4, "w " * 70 + "general public license " + "x " * 40 + " cc by"), (4, "Cc by"), (None, "mit license")]
    got = license_scan.scan(spark.createDataFrame([(d, t, "", "", "") for d, t in rows], DOCS)).collect()
    phrases = [t.words.split() for t in license_scan.TEMPLATES if t.base]
    for (_, text), r in zip(rows, got):
        w = words_of(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        at = [i for p in phrases for i in range(len(w)) if w[i:i + len(p)] == p]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(w), len(at), min(at, default=None), max(at, default=None))


def test_vector_links_recall(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((300, 32))
    v[100:200] = v[:100] + 0.15 * rng.standard_normal((100, 32))
    v[200:210] = v[0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    bad = [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, [None] * 32), (904, [1.0])]
    got = {r.vec_id: r for r in vector_links.vector_components(
        spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    true = ((u @ u.T) >= 0.95).sum(axis=1) - 1
    links = np.array([got[i].n_links for i in range(300)])
    assert (links <= true).all() and links.sum() >= 0.9 * true.sum() > 0
    assert all(got[i].n_links == 0 and got[i].kept for i, _ in bad)


def test_recounts_equal_full_counts():
    library = Tokenizer.from_file(BYTE_BPE)
    library.encode_special_tokens = True
    rng, letters, encode = random.Random(1), "ab '’re ll  \n\n\t1 2é ü.!?-,'s't'm'd  <|endoftext|>ß 日本", encoder(BYTE_BPE)

    def text_of(lengths):
        return "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))

    for _ in range(100):
        text = text_of([0, 3, 40, 1500])
        tree = token_counts.build(encode, text)
        for _ in range(6):
            tree, text, _ = token_counts.edit(encode, tree, text, rng.randrange(len(text) + 1),
                                              rng.choice([0, 1, 2, 5, 80]), text_of([0, 1, 2, 7, 120]))
            assert (tree.tokens[0], tree.chars[0]) == (
                len(library.encode(text, add_special_tokens=False).ids), len(text))


def test_packing_is_gapless(spark):
    rows = packing.best_fit_packing(spark.createDataFrame(fixture(), DOCS), BYTE_BPE).collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        ends = 0
        for at, n in sorted(spans):
            assert at == ends
            ends = at + n
        assert ends <= 1024


@pytest.mark.parametrize("empty", [True, False])
def test_pipeline_stages(spark, empty):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.limit(0) if empty else docs
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns and after.count() <= docs.count()
        docs = after
    assert (pipeline.STAGES[-1][1](spark, docs, "").count() == 0) == empty


def test_sequences_hold_the_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "no id"), (901, None), (901, None), (902, "")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    library = Tokenizer.from_file(BYTE_BPE)
    want = sorted((r.doc_id or -1, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in docs.collect())
    rows = packing.sequences(docs, BYTE_BPE).collect()
    assert all(0 < len(r.ids) <= packing.CAPACITY for r in rows)
    packed = packing.best_fit_packing(docs, BYTE_BPE).collect()
    by_sequence = {r.sequence_id: r.ids for r in rows}
    assert set(by_sequence) == {p.sequence_id for p in packed}
    ends = [i for r in rows for i in r.ids if i == 2]
    assert len(ends) >= len(want) and sum(len(r.ids) for r in rows) == sum(len(ids) for _, ids in want)
    import zlib
    for p in packed:
        ids = by_sequence[p.sequence_id][p.offset:p.offset + p.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == p.ids_crc32
    assert packing.sequences(docs.limit(0), BYTE_BPE).count() == 0


def test_license_notices_equal_brute_force(spark):
    """Labels, score and spans against every window of words; two texts that hold
    a notice's words in no order get no label."""
    rng = random.Random(9)
    notices = [t for t in license_scan.TEMPLATES if not t.base]
    longest = max(len(t.words.split()) for t in notices)
    rows = [(1, "we apache tribe sold a license for version 2 of the map , 0 left"),
            (2, "under a tree the mit student lost a license"), (3, None), (4, ""), (5, "All rights reserved. CC-BY")]
    for i in range(40):
        t = rng.choice(notices)
        words = t.words.split()
        for _ in range(rng.choice([0, 0, 2, 5, 20])):
            words[rng.randrange(len(words))] = "other"
        filler = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 300))]
        at = rng.randrange(len(filler) + 1)
        rows.append((10 + i, " ".join(filler[:at] + words + filler[at:])))
    df = spark.createDataFrame([(d, t, "", "", "") for d, t in rows], DOCS)
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    assert len(got) == len(rows) and license_scan.scan(df.limit(0)).count() == 0

    def grams(w):
        return [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hits = 0
    for d, text in rows:
        w = words_of(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        sure, possible, best = set(), set(), 0.0
        for t in notices:
            own, runs = set(grams(t.words.split())), grams(w)
            share = max((len(own & set(runs[i:i + len(t.words.split()) - 2])) for i in range(len(runs))), default=0) / len(own)
            wide = max((len(own & set(runs[i:i + 2 * longest])) for i in range(len(runs))), default=0) / len(own)
            if share >= t.threshold:  # in a run as long as the notice: a block must meet it
                sure.add(t.label)
            if wide >= t.threshold:  # in a run as long as a block: one may
                possible.add(t.label)
        r = got[d]
        labels = {x.label for x in r.notices}
        assert sure <= labels <= possible and r.labels == ",".join(sorted(labels | set(filter(None, r.base_labels.split(",")))))
        for x in r.notices:
            hits += 1
            own = {g for t in notices if t.label == x.label for g in grams(t.words.split())}
            assert x.share >= 0.75 and tuple(w[x.first_word:x.first_word + 3]) in own
            assert tuple(w[x.last_word - 2:x.last_word + 1]) in own and r.score >= x.share
    assert got[1].labels == got[2].labels == "" and got[1].score == 0.0
    assert got[5].labels == "cc-by,reserved" and got[5].score == 1.0
    assert hits >= 25

