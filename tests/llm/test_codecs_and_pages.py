"""Exact dedup, the word BPE codec, main text and the archive on small fixtures."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from legwise.llm import bpe, exact_dedup, html_text, packing, warc

DOCS = "doc_id long, text string, digest string, win string, n string"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LETTERS = [*"abcdefgh THE  \n\t12é'’ßſİıKŒœǅ日本x.!?-_ʼnʹ̀​ \x85\x00", "'s", "'LL", "ing", "the ",
           "<|endoftext|>", "<|startoftext|>", "<|", "🙂", "ﬁ", "Ⅷ", "½", "٣"]


@pytest.mark.parametrize("counters", [1, 1024])
def test_exact_dedup_equals_brute_force(spark, counters):
    texts = [None, "", "a", "a ", "A"] + ["hot"] * 40 + ["x" * 100_000] * 2
    rows = [(i % 44, t) for i, t in enumerate(texts)] + [(None, "a"), (None, None), (7, "hot"), (7, "hot")]
    docs = spark.createDataFrame([(d, t, "clash", None, "") for d, t in rows], DOCS).repartition(3)
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    top = {t: max((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    got = exact_dedup.exact_dedup(docs, counters=counters).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.keep_id, r.group_size, r.text_sha256) for r in got) \
        == sorted((d if d is not None else -1, top[t or ""], len(groups[t or ""]),
                   hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)
    stay = sorted((r.keep_id, r.text_sha256) for r in got if r.kept)
    assert len(stay) == len(groups) == len(set(stay))
    left = exact_dedup.drop_copies(docs, counters=counters)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == sorted((top[t], t) for t in groups)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_word_bpe_equals_library():
    library, codec, rng = Tokenizer.from_file(WORD_BPE), bpe.word_bpe(WORD_BPE), random.Random(1)
    library.no_truncation()
    library.no_padding()
    for _ in range(3000):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 3, 10, 40, 200])))
        ids = np.frombuffer(codec.ids(text), np.uint32).astype(np.int64)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert codec.decode(ids, np.array([0, len(ids)])).to_pylist() == [
            library.decode(want, skip_special_tokens=False)], text


def test_word_bpe_columns(spark):
    library = Tokenizer.from_file(WORD_BPE)
    texts = [None, "", "  ", "Hello world", "ab" * 60_000, "the quick " * 20_000, "Hello world"]
    docs = spark.createDataFrame([(i or None, t, "clash") for i, t in enumerate(texts)],
                                 "doc_id long, text string, decoded_ string")
    got = bpe.decode(bpe.encode(docs, WORD_BPE), WORD_BPE).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    for text, r in zip(texts, got):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert (r.ids, r.decoded, r.text) == (want, library.decode(want, skip_special_tokens=False), text)
    assert bpe.decode(bpe.encode(docs.limit(0), WORD_BPE), WORD_BPE).count() == 0


SHELL = ('<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
         '<nav><ul><li><a href="/x">menu</a></li></ul></nav><header>top</header><div class="ad">buy</div>'
         '%s<aside>side</aside><div class="comments"><p>reader</p></div>'
         '<form><p>name</p></form><footer>&copy; foot</footer></body></html>')


@pytest.mark.parametrize("body, text", [
    ("<article><h1>A  title</h1><p>One &amp; <b>two</b>\n three<p>x &lt; y&nbsp;z</article>",
     "A title\nOne & two three\nx < y z"),
    ('<div id="content"><p>one<br>two</p><!-- <p>no</p> --><ul><li>a<li>b</ul></div>', "one two\na\nb"),
    ('<article><p>kept</p><div class="share">tweet</div><p>kept too</p><script>no()</script></article>',
     "kept\nkept too"),
    ("<main><table><tr><td>c1<td>c2</table><p>A < B and more</main>", "c1\nc2\nA < B and more"),
    ('<article><p title="a > b">quoted</p><p>&#65;&eacute;&unknown;</p></article>', "quoted\nAé&unknown;"),
    ('<div class="widget-page"><article><p>wrapped</p></article></div>', "wrapped"),
    ('<div class="widget-page"><h1>wrapped</h1></div>', "wrapped"),
    ("", ""),
])
def test_main_text_of_one_page(body, text):
    assert html_text.main_text(SHELL % body)[0] == text


def test_host_consensus_and_odd_pages(spark):
    page = SHELL % '<div class="story n%d"><p>main story %d, long enough to win the vote</p></div>'
    rows = [(i, "https://A.example:8080/p", page % (i, i), "clash") for i in range(20)]
    # A page with more than its host's story yields all of it.
    rows.append((20, "https://a.example/q", SHELL % (
        '<div class="story n20"><p>short</p></div><div class="other"><p>' + "filler " * 200 + "</p></div>"), ""))
    rows += [(21, None, None, None), (22, "https://b.example", "", ""), (None, "nonsense", "<p>cut off <b>tex", ""),
             (23, "https://c.example", "<p>" + "word " * 50_000, ""), (23, "https://c.example", "plain & simple", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {(r.page_id, r.n_chars): r.text for r in html_text.extract_main_text(pages).collect()}
    assert len(got) == len(rows)
    for i in range(20):
        assert f"main story {i}, long enough to win the vote" in got.values()
    odd = "short\n" + ("filler " * 200).strip()
    assert got[20, len(odd)] == odd and got[21, 0] == got[22, 0] == ""
    assert got[None, 11] == "cut off tex" and got[23, 14] == "plain & simple"
    assert got[23, 249_999] == ("word " * 50_000).strip()
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_main_text_is_whole(spark):
    long = "word " * 500 + "end"
    body = "<article><h1>Title</h1><p>lead</p><div class=body><p>" + long + "</p></div><p>close</p></article>"
    # the best container is where most of the prose is; the text is more than that
    assert html_text.main_text(SHELL % body) == (f"Title\nlead\n{long}\nclose", "/html/body/article/div.body")
    # Short pages elect a part of the article; a rarer layout outside an article is one of several.
    intro, plain = '<article><div class="intro">in</div>%s</article>', '<div class="intro">in</div>%s'
    more = '<div class="body"><p>' + long + "</p></div>"
    rows = [(i, "https://a.example/", SHELL % (intro % (more if i < 1 else ""))) for i in range(40)]
    rows += [(100 + i, "https://b.example/", SHELL % (plain % (more if i < 4 else ""))) for i in range(40)]
    got = {r.page_id: r.text for r in html_text.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: "in" for i, *_ in rows}, **{i: f"in\n{long}" for i in (0, 100, 101, 102, 103)}}


@pytest.mark.parametrize("body, text", [
    ('<article><header class="entry-header"><h1>Title</h1></header><p>one</p></article>', "Title\none"),
    ('<main><section id="navigation"><p>a</p></section><section id="share"><p>b</p></section><p>c</p></main>', "a\nb\nc"),
    ('<div role="main" class="form"><div class="notice search"><p>a</p></div><p>b</p></div>', "a\nb"),
    ('<article><div class="ad">buy</div><pre>f() <span class="hljs-comment"># call</span></pre></article>', "f() # call"),
    ('<article><p>a</p><div class="comments"><p>' + "word " * 19 + "end</p></div></article>", "a"),
    ('<article><p>a</p></article><div class="related"><article><p>' + "word " * 30 + "</p></article></div>", "a"),
])
def test_words_cut_little_of_an_article(body, text):
    assert html_text.main_text(SHELL % body)[0] == text


def test_reader_comments_go_from_every_page(spark):
    said = '<div class="comments"><p>' + "reply " * 30 + "</p></div>"
    rows = [(i, f"https://{'a' if i < 4 else 'b'}.example/", SHELL % (
        f"<article><p>story {i}</p>{said if i in (0, 1, 4) else ''}</article>")) for i in range(8)]
    got = {r.page_id: r.text for r in html_text.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"story {i}" for i in range(8)}


@pytest.mark.parametrize("least", [0, 3])
def test_archive_round_trip(spark, least):
    rows = [(1, "http://a/x y\r\nz", "same"), (5, "http://b", "same"), (3, None, "same"), (2, "u", None), (4, "u", ""),
            (6, "u", "é" * 50_000), (7, "u", "ab"), (8, "u", "ab"), (None, "u", "same"), (5, "http://b", "same")]
    pages = spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows],
                                  "page_id long, url string, html string, strong string")
    archive = warc.write_archive(pages, min_revisit_bytes=least)
    back = warc.read_back(spark, archive).collect()
    assert len(back) == len(rows) and all(r.verified for r in back)
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    tops = {h: max((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    sizes = {len(h.encode()): h for h in groups}
    for r in back:
        html = sizes[r.payload_bytes]
        if r.record_type == "response":
            assert r.refers_to is None and (r.page_id == tops[html] or len(html.encode()) < least)
        else:
            assert r.refers_to == tops[html] and len(html.encode()) >= least
    assert sum(r.record_type == "response" for r in back) == sum(
        1 if len(h.encode()) >= least else len(ids) for h, ids in groups.items())
    whole = warc.reconstruct(spark, archive).collect()
    assert sorted(bytes(r.payload).decode() for r in whole) == sorted(h or "" for _, _, h in rows)
    assert all(bytes(r.record).startswith(b"WARC/1.1\r\n") and bytes(r.record).endswith(b"\r\n\r\n") for r in whole)
    assert warc.read_back(spark, warc.write_archive(pages.limit(0))).count() == 0


def test_packing_pieces_equal_library(spark):
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(2)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    texts = [None, "", " ", "word " * 1023, "word " * 1024, "é日 " * 5000, "<|endoftext|>x"] + [
        "".join(rng.choice(LETTERS) for _ in range(rng.choice([1, 40, 3000]))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, piece string")
    got = {}
    for r in packing.best_fit_packing(docs, path).collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        assert sorted(got[i]) == [(k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                                  for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
