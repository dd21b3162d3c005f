"""Quality voting, spelling variants and whitening: brute force, accuracy and
odd input."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from legwise.llm import quality, spelling_variants, whitening

MID = "/root/testdata/sf0.01"


# Spelling variants

def expected_variants(rows, min_count=5, ratio=5):
    import re
    counts = Counter()
    for doc_id, text in rows:
        low = (text or "").encode().lower().decode()
        for run, n in Counter(re.findall("[a-zÀ-ÿ]+", low)).items():
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += n
    words = {w: n for w, n in counts.items() if n >= min_count}
    near, holes = defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1:]
            holes[i, shorter].append(w)
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in holes.values():
        for a in same:
            near[a] |= {b for b in same if b != a}
    form = {w: min(near[w], key=lambda o: (-words[o], o)) for w in words if near[w]}
    form = {w: f for w, f in form.items() if words[f] >= ratio * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None)
    return out


def variants(df, **kwargs):
    rows = spelling_variants.group_variants(df, **kwargs).collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_of_a_table_equal_brute_force(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    want = expected_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(1 for w in want.values() if w[0]) > 100
    assert variants(docs) == want


@pytest.mark.parametrize("limit", [1, 64, 1 << 18])
def test_variants_of_dense_words_equal_brute_force(spark, limit):
    """Two letters, so that nearly every word has near words and every place of
    an edit occurs; with a small dictionary all grams stay short."""
    rng = random.Random(limit)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(6, 12))) for _ in range(400)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "àaaaaa", "aaaaaÿ", "x" * 40, "x" * 41, "x" * 20 + "y" + "x" * 20]
    text = [(i, " ".join(rng.choices(words, k=300))) for i in range(20)] + [(99, " ".join(words * 5))]
    df = spark.createDataFrame(text, "doc_id long, text string")
    assert variants(df, limit=limit) == expected_variants(text)


def test_variants_odd_rows(spark):
    chain = " ".join(["letter"] * 200 + ["lettar"] * 30 + ["lattar"] * 5 + ["Étoile"] * 5 + ["étoile"] * 5)
    text = [(None, chain), (1, None), (2, ""), (3, "12 !? short"), (7, "straße " * 6), (7, "straße " * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in text], "doc_id long, text string, word string, n int")
    got = variants(df)
    assert got == expected_variants(text)
    assert got["lattar"][:2] == ("lettar", "letter")
    assert {"Étoile", "étoile"} <= set(got)  # only A-Z is lowered
    assert variants(df.limit(0)) == {}


def test_every_edit_leaves_a_gram():
    """The places a word and its near word enter always meet."""
    rng = random.Random(5)
    for _ in range(400):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(6, 14)))
        i = rng.randrange(len(word))
        other = rng.choice([word[:i] + rng.choice("abc") + word[i + 1:], word[:i] + word[i + 1:]])
        if other == word or len(other) < 6:
            continue
        extend = frozenset(g for g in ("".join(rng.choice("\x01abc\x02") for _ in range(rng.randint(2, 6)))
                                       for _ in range(300)))
        group = min(len(word), len(other))
        longest = spelling_variants.longest_gram(group)

        def lists(w):
            grams = spelling_variants.decompose(w, extend, longest)
            rows = pa.table({"grp": [group] * len(grams), "word": [w] * len(grams), "n": [5] * len(grams),
                             "mask": [0] * len(grams), "start": [s for s, _, _ in grams],
                             "stop": [e for _, e, _ in grams], "gram": [g for _, _, g in grams],
                             "c": [zlib.crc32(g.encode()) % 7 for _, _, g in grams]})
            out = spelling_variants._chosen(rows)
            return list(zip(out["start"].to_pylist(), out["gram"].to_pylist()))
        one, two = lists(word), lists(other)
        assert any(g == h and q - p in ((0,) if len(word) == len(other) else (0, len(other) - len(word)))
                   for p, g in one for q, h in two), (word, other)


# Whitening

def check_whitening(spark, df, dim, rows_left, comps=16):
    got = whitening.whiten(df).toPandas()
    x = np.array([[int(np.floor(64 * float(np.float64(c)))) + 1000000 for c in v] for v in rows_left], np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    y = (fit - 1000000) - (total - n * 1000000) / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(comps, int((values > 1e-13 * values[0]).sum()))
    assert sorted(got["component"].unique()) == list(range(1, k + 1))
    assert len(got) == len(x) * k
    assert (got["n"] == n).all()
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    share = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(share, values[:k] / values.sum(), rtol=1e-9)
    deviation = ((n * x - total) ** 2).sum(axis=1)
    assert sorted(got[got["component"] == 1]["deviation"]) == sorted(deviation.tolist())
    return got, x, n, total, values, vectors


def test_whitening_of_a_table(spark):
    df = spark.read.parquet(f"{MID}/embeddings.parquet")
    rows = df.collect()
    good = [r for r in rows if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    got, x, n, total, values, vectors = check_whitening(spark, df, len(good[0].embedding), [r.embedding for r in good])
    white = got.pivot(index="vec_id", columns="component", values="whitened")
    y = (x - total / n) @ (vectors[:, :16] / np.sqrt(values[:16]))
    for c in range(16):
        gaps = np.abs(values - values[c])
        gaps[c] = np.inf
        if gaps.min() < 1e-6 * values[0]:
            continue
        mine = white.loc[[r.vec_id for r in good], c + 1].to_numpy()
        assert np.allclose(mine * np.sign(mine @ y[:, c]), y[:, c], atol=1e-6)


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=5).tolist() for _ in range(60)]
    vectors += vectors[:20] * 3  # copies count once in the fit
    rows = [(i if i % 7 else None, v) for i, v in enumerate(vectors)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [float("inf")] + [0.0] * 4)]
    df = spark.createDataFrame([(*r, 1.5, 3) for r in rows + bad],
                               "vec_id long, embedding array<double>, whitened double, n int")
    check_whitening(spark, df, 5, vectors)
    assert whitening.whiten(df.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0  # no variance
    flat = [[float(a), 0.0, float(2 * a)] for a in range(9)]
    flat_df = spark.createDataFrame(list(enumerate(flat)), "vec_id long, embedding array<double>")
    check_whitening(spark, flat_df, 3, flat)
    both = flat_df.unionByName(df.select("vec_id", "embedding"))
    assert whitening.whiten(both).count() == 9 + 5 * len(vectors)


@pytest.mark.parametrize("dim", [1, 2, 7, 40])
def test_spectra_of_parts_combine(dim):
    rng = np.random.default_rng(dim)
    x = rng.integers(-50, 50, (120, dim))
    x[40:60] = x[0]
    x[:, dim // 2] *= 1000
    whole = whitening.Spectrum(dim)
    for part in np.split(x, [1, 30, 31, 90]):
        own = whitening.Spectrum(dim)
        for row in part:
            own.add(row)
        whole.join(own)
    y = x - x.mean(axis=0)
    scatter = y.T @ y
    assert whole.n == 120 and (whole.sums == x.sum(axis=0)).all()
    assert np.allclose(whole.basis @ np.diag(whole.values) @ whole.basis.T, scatter, atol=1e-9 * np.abs(scatter).max())
    assert np.allclose(whole.basis.T @ whole.basis, np.eye(dim), atol=1e-11)


# Quality

def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(got[r.doc_id].predicted, r.quality, got[r.doc_id].score) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q, _ in held) >= 0.98 * len(held)
    good, poor = [s for _, q, s in held if q == 1], [s for _, q, s in held if q == 0]
    assert np.mean([[g > p for p in poor] for g in good]) > 0.99


def test_quality_votes_equal_brute_force():
    rng = np.random.default_rng(0)
    unit = rng.normal(size=(50, 6)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    voters = quality.Voters(unit, rng.integers(0, 2, 50).astype(float), rng.random(50) + 0.5, 0.7)
    asked = unit[::-1] + 0.1
    for y, score in zip(asked, voters.score(asked)):
        cosine = unit @ y
        top = np.argsort(-cosine)[:quality.NEIGHBOURS]
        vote = np.maximum(cosine[top].astype(float), 0) ** quality.SHARPNESS * voters.weight[top]
        assert abs(score - ((vote * voters.label[top]).sum() + 0.7) / (vote.sum() + 1)) < 1e-5


def test_quality_odd_rows(spark):
    text = [(i, f"plain words of a text number {i} that reads on") for i in range(40)]
    text += [(i, "!!! $$$ ### %%%" * 3) for i in range(40, 60)]
    odd = [(None, "plain words"), (70, None), (71, ""), (72, "   "), (5, text[5][1]), (73, "long " * 300_000)]
    docs = spark.createDataFrame([(*r, "en", 0.5, 1) for r in text + odd],
                                 "doc_id long, text string, lang string, score double, predicted int")
    known = [(i, int(i < 40)) for i in range(60)] + [(3, 1), (None, 0), (8, None), (999, 0)]
    labels = spark.createDataFrame(known, "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == docs.count()
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert len(by_id[5]) == 2 and by_id[5][0] == by_id[5][1]
    assert by_id[None][0].held_out is False
    assert {by_id[i][0].score for i in (70, 71, 72)} == {by_id[70][0].score}
    assert all(by_id[i][0].predicted == 1 for i in range(40))
    assert all(by_id[i][0].score < 0.3 for i in range(40, 60))
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and len(none) == len(got)
    assert quality.classify(docs.limit(0), labels).count() == 0
    few = quality.classify(docs, labels, exemplars=8).collect()  # a sample of the labels keeps their balance
    assert {r.predicted for r in few if r.doc_id is not None and r.doc_id < 40} == {1}
