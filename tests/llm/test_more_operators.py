"""The n-gram join, vector links, main text and the pipeline against brute
force or pages read by hand."""

import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from legwise.llm import html_text, language_id, shingle_join, vector_links

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def shingles(text):
    low = (text or "").encode().lower().decode()
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def groups(keys, links):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def jaccard_links(sets):
    """Pairs of ids that link, by counting common shingles."""
    by_shingle, found = defaultdict(list), set()
    for k, s in sets.items():
        for x in s:
            by_shingle[x].append(k)
    common = defaultdict(int)
    for ids in by_shingle.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                common[a, b] += 1
    for (a, b), o in common.items():
        if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
            found.add((a, b))
    return found


def test_join_of_a_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.select("doc_id", "text").collect()}
    want = groups(sets, jaccard_links(sets))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.jaccard_components(docs).collect()}
    assert got == {k: (len(s), want[k]) for k, s in sets.items()}


def test_join_of_a_large_group_of_near_copies(spark):
    """A hot group: copies of one text with some words changed, among texts that
    share a passage and no more."""
    rng = np.random.default_rng(4)
    base, passage = [f"b{i}" for i in range(80)], [f"p{i}" for i in range(60)]
    rows = []
    for i in range(400):
        words = list(base)
        for j in rng.integers(0, 80, rng.integers(0, 4)):
            words[j] = f"n{rng.integers(0, 50)}"
        rows.append((i, " ".join(words)))
    for i in range(400, 700):
        own = [f"w{rng.integers(0, 3000)}" for _ in range(rng.integers(10, 80))]
        rows.append((i, " ".join(own[:5] + passage + own[5:])))
    sets = {i: shingles(t) for i, t in rows}
    want = groups(sets, jaccard_links(sets))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.component_id for r in shingle_join.jaccard_components(df).collect()}
    assert got == want


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(1)
    keys = [np.unique(rng.integers(0, 1 << 40, rng.integers(1, 900))) for _ in range(40)]
    keys += [np.concatenate([k[:-3], rng.integers(0, 1 << 40, 2)]) for k in keys if len(k) > 3]
    bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    sig = shingle_join.signatures(np.concatenate(keys), bounds).reshape(len(keys), -1).view(np.uint64)
    for i, a in enumerate(keys):
        for j, b in enumerate(keys):
            bits = sum(int(x ^ y).bit_count() for x, y in zip(sig[i].tolist(), sig[j].tolist()))
            assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


def vector_want(rows, threshold=0.95):
    good = [(k, v) for k, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links, counts = [], defaultdict(int)
    for i, (a, v) in enumerate(good):
        for b, w in good[i + 1:]:
            if len(v) == len(w) and np.dot(v, w) >= threshold * np.linalg.norm(v) * np.linalg.norm(w) - 1e-12:
                links.append((a, b))
                counts[a] += 1
                counts[b] += 1
    home = groups([k for k, _ in rows], links)
    return {k: (counts[k], home[k], home[k] == k) for k, _ in rows}


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    rows = []
    for c in range(30):
        centre = rng.normal(size=24)
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows), (centre + 0.05 * rng.normal(size=24)).tolist()))
    rows += [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [None] * 24), (904, []),
             (910, [1.0, 2.0]), (911, [1.0, 2.0]), (912, [2.0, 4.0]), (913, [-1.0, 2.0]), (914, [3.0])]
    df = spark.createDataFrame([(*r, 7, False) for r in rows], "vec_id long, embedding array<double>, n_links int, kept boolean")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_links.vector_components(df).collect()}
    assert got == vector_want(rows)
    assert got[910] == (2, 910, True) and got[912] == (2, 910, False)
    assert vector_links.vector_components(df.limit(0)).count() == 0


def test_vector_links_of_repeated_rows(spark):
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [1.0, 0.01])]
    got = sorted((r.vec_id or -1, r.n_links, r.component_id) for r in vector_links.vector_components(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(-1, 3, 3), (3, 3, 3), (5, 3, 3), (5, 3, 3)]


def test_language_of_odd_tables(spark):
    shape = "doc_id long, text string, lang string, source string, `my col` int, row string, language string"
    rows = [(1, "the cat and the dog", "en", "a", 1, "r", "l"), (1, "the cat and the dog", "en", "a", 1, "r", "l"),
            (2, "der hund und die katze", "de", None, 2, "r", None), (None, "the cat saw a dog " * 60_000, "en", "b", None, None, None)]
    df = spark.createDataFrame(rows, shape)
    found = language_id.identify_documents(df).collect()
    assert len(found) == 4 and [set(r.row.asDict()) for r in found] == [set(df.columns)] * 4
    assert sorted(str(r.language) for r in found if r.row.doc_id) == ["de", "en", "en"]
    assert language_id.identify_documents(df.limit(0)).count() == 0


PROSE = "This is a sentence of the story that runs on for a while, as number {0} of the page says in so many words."
#: (body, main text) of pages read by hand; {0} is the number of the page.
PAGES = {
    "form around all": ('<form id="f"><div id="top"><a href="/">home</a></div><div><h1>Title {0}</h1><p>' + PROSE
                        + '</p></div><div><label>name</label><input><button>send</button></div></form>', None),
    "form, no heading": ('<form id="f"><div class="page"><p>' + PROSE + '</p><p>Short end {0}.</p></div></form>',
                         PROSE + "\nShort end {0}."),
    "class search-guide": ('<div class="post">One line {0}.</div><div class="search-guide"><p>' + PROSE * 4 + "</p></div>",
                           "One line {0}.\n" + PROSE * 4),
    "sidebar in main": ('<main><h1>Title {0}</h1><p>' + PROSE + '</p><div class="sidebar">popular now</div></main>',
                        "Title {0}\n" + PROSE),
    "comments in article": ("<article><h1>Title {0}</h1><p>" + PROSE + '</p><div class="comments"><p>' + "a reader said {0} " * 10
                            + "</p></div></article>", "Title {0}\n" + PROSE),
    "comments, no article": ('<div class="text"><p>' + PROSE + '</p></div><ul id="comments"><li><p>' + "reader {0} replied " * 9
                             + "</p></li></ul>", PROSE),
    "no article at all": ("<p>" + PROSE + "</p><p>{0} is short</p>", PROSE + "\n{0} is short"),
    "menu without a name": ('<div class="x9"><ul><li><a href="/a">one</a></li><li><a href="/b">two</a></li>'
                            '<li><a href="/c">three</a></li></ul></div><div class="t"><p>' + PROSE + "</p></div>", PROSE),
    "layout table": ('<table><tr><td class="nav"><a href="/">home</a><td><h1>Title {0}</h1><p>' + PROSE
                     + '</p></td><td class="sidebar">tags</td></tr></table>', "Title {0}\n" + PROSE),
    "article header": ('<header>Site</header><article><header class="entry-header"><h1>Title {0}</h1></header><p>' + PROSE
                       + '</p><section id="forms"><h2>Forms</h2><p>' + PROSE + "</p></section></article><footer>end</footer>",
                       "Title {0}\n" + PROSE + "\nForms\n" + PROSE),
    "links in prose": ("<article><p>See <a href='/a'>this</a>, <a href='/b'>that</a> and <a href='/c'>more</a> of {0}.</p>"
                       "<ul><li><a href='/d'>a source</a></li></ul></article>", "See this, that and more of {0}.\na source"),
    "cookie notice": ('<div class="cookie-bar"><p>' + "We use cookies to make this site work for you. " * 4 + "</p></div>"
                      "<div><h1>Title {0}</h1><p>" + PROSE + "</p></div>", "Title {0}\n" + PROSE),
    "wrapper with a sidebar class": ('<div class="has-sidebar menu-open"><div class="sidebar">tags</div><article><p>' + PROSE
                                     + "</p></article></div>", PROSE),
    "code and spans": ("<main><pre>f({0}) <span class='c comment'># note</span></pre><p>" + PROSE
                       + " <span class='share'>tweet</span></p></main>", "f({0}) # note\n" + PROSE),
}
PAGES["form around all"] = (PAGES["form around all"][0], "Title {0}\n" + PROSE)


@pytest.mark.parametrize("pages_of_host", [1, 40])
def test_pages_by_hand(spark, pages_of_host):
    rows, want = [], {}
    for h, (shape, (body, text)) in enumerate(PAGES.items()):
        for i in range(pages_of_host):
            k = h * 1000 + i
            rows.append((k, f"https://h{h}.example.org/{i}", "<html><body>" + body.format(i) + "</body></html>"))
            want[k] = (shape, text.format(i))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_main_text(df).collect()}
    wrong = {want[k][0]: (got[k], want[k][1]) for k in want if got[k] != want[k][1]}
    assert wrong == {}


def test_what_repeats_outside_of_the_article_goes(spark):
    """An unnamed box that says the same on every page of a host, and the same
    box on a host of one page, which nothing tells from text."""
    page = '<div class="box">Welcome to our little site</div><div class="text"><p>{0}</p></div>'
    rows = [(i, "https://a.example/", page.format(PROSE.format(i))) for i in range(12)]
    rows += [(50, "https://b.example/", page.format(PROSE.format(50)))]
    rows += [(60 + i, "https://c.example/", page.format(PROSE.format(0))) for i in range(5)]  # copies of one page
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_main_text(df).collect()}
    assert all(got[i] == PROSE.format(i) for i in range(12))
    assert all(got[k].startswith("Welcome") and PROSE.format(n) in got[k] for k, n in [(50, 50), (60, 0), (64, 0)])


def test_pipeline_equals_brute_force(spark):
    """Each stage against a plain version of it, on what the stage before kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, SMALL)
    spoken = {r.doc_id for r in kept.select("doc_id").collect()}
    lettered = {k for k, t in rows.items() if re.search(r"[^\W\d_]", t or "")}
    assert spoken <= lettered and len(spoken) >= 0.97 * len(lettered)

    exact = stages["exact_dedup"](spark, kept, SMALL)
    last = {}
    for k in sorted(spoken):
        last[rows[k] or ""] = k
    assert {r.doc_id for r in exact.collect()} == set(last.values())

    near = stages["ngram_join"](spark, exact, SMALL)
    sets = {k: shingles(rows[k]) for k in last.values()}
    home = groups(sets, jaccard_links(sets))
    assert {r.doc_id for r in near.collect()} == {k for k in sets if home[k] == k}

    pieces = stages["packing"](spark, near, SMALL).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = defaultdict(dict)
    for p in pieces:
        by_doc[p.doc_id][p.piece] = p
    assert set(by_doc) == {k for k in sets if home[k] == k}
    for k, parts in by_doc.items():
        ids = library.encode(rows[k] or "", add_special_tokens=False).ids + [2]
        at = 0
        for i in range(len(parts)):
            p = parts[i]
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    used = defaultdict(list)
    for p in pieces:
        used[p.sequence_id].append((p.offset, p.length))
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(used) <= -(-sum(p.length for p in pieces) // 1024) * 1.02 + 1
