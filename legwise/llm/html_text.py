"""Operator 7: main text of web pages by consensus host paths.

1. Scores. A page is cut into elements and text blocks. Every element is scored:
   its prose (words of blocks that run on, outside links) and the share of the
   page's prose speak for it, the share of links against it, and so does, as one
   weak feature, what its tag, role and class names say. An element that holds the
   page's first article, main part or first-level heading is no furniture,
   whatever its class. The prose of a block counts for the containers around it,
   halved at each step out; the container with the most is the page's best.
2. Votes, summed in Spark per host and generalised path (tags with their classes,
   digits folded): the best containers of the host's pages; the scores of marked
   elements; and whether an element says the same on all of the host's pages,
   while the pages differ.
3. Every page is extracted again with the paths that won: elements around the
   host's container are kept; marks that the page's own score leaves open are
   decided by the host's sum; what repeats outside of the container, or in a marked
   place, is furniture. All text that is not furniture is the main text; text is
   never cut for lying elsewhere than the host's container.

Sums per host are joined, never gathered: no window, and what is kept of a host is
bounded (paths on a fiftieth of its pages). The winners are broadcast only if
their measured size stays under a bound; else both sides are shuffled on the host
and AQE splits a hot host.

Defined results: null or empty html, and pages without text but furniture, give
the empty text; a page all of whose text is marked by class names alone keeps it;
a page without a host votes in the group of the empty host;
unclosed and stray tags are repaired as browsers do for paragraphs and lists; a
cut-off page gives the text up to its end; repeated rows and null ids are pages
of their own; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwise.llm.common import cut

#: Words from which a block is running text; fewer do if it ends as a sentence does.
RUNNING, SENTENCE = 20, 8
#: Pages that must say the same, and share of a host's pages a path must be on to count.
REPEATED, ON_PAGES = 3, 0.02
#: Score below which a page decides on a marked element by its host.
OPEN = 1.0
#: Bytes of the hosts' paths up to which they are broadcast.
BROADCAST_BYTES = 32 << 20
#: What marks weigh: never outweighed by prose, hardly ever, easily.
STRONG, MIDDLE, WEAK = -3.0, -2.6, -1.0
MOST_PROSE, HOLDS_ARTICLE = 2.5, 6.0

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("html body article main section div td center form".split())
TAG_MARKS = {**dict.fromkeys("head nav footer aside button select menu dialog label legend".split(), STRONG),
             **dict.fromkeys("form fieldset".split(), WEAK)}
ROLE_MARKS = {**dict.fromkeys("navigation banner contentinfo complementary search dialog menu menubar alert "
                              "alertdialog".split(), STRONG), "form": WEAK}
STRONG_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense comment comments commentlist cookie cookies "
    "consent disqus gdpr sponsor sponsored".split())
MIDDLE_WORDS = frozenset(
    "banner banners breadcrumb breadcrumbs login menu menus modal nav navbar newsletter pager pagination popup promo "
    "promoted promotion related share sharing sidebar sidenav signup social subscribe subscription toolbar topbar "
    "widget widgets".split())
#: Words that say little, and nothing inside an article.
WEAK_WORDS = frozenset("feedback footer form forms header masthead navigation notice notices replies reply respond "
                       "search".split())
CODE_WORDS = frozenset("comment comments".split())  # of a highlighted line
NOT_OWN = frozenset("with has no without".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*)"
                   r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")


class Element:
    """A block-level or inline element. ``mark`` is what its tag, role and
    classes say against it, ``named`` whether classes alone say it."""
    __slots__ = ("tag", "path", "parent", "mark", "named", "hidden", "article", "words", "links", "prose", "holds", "digest")

    def __init__(self, tag: str, path: str, parent: "Element | None", mark: float, named: bool, hidden: bool, article: bool):
        self.tag, self.path, self.parent, self.mark, self.named = tag, path, parent, mark, named
        self.hidden, self.article = hidden, article
        self.words = self.links = self.prose = self.digest = 0
        self.holds = False

    def up(self):
        at = self
        while at is not None:
            yield at
            at = at.parent


class Block:
    """A run of text with its words, those in links, and its owner element."""
    __slots__ = ("text", "owner", "words", "links", "prose")

    def __init__(self, text: str, owner: Element, links: int):
        self.text, self.owner = text, owner
        self.words = len(text.split())
        self.links = min(links, self.words)
        runs = self.words >= RUNNING or self.words >= SENTENCE and text[-1] in ".!?\u2026\"\u201d\u00bb)"
        self.prose = self.words - self.links if runs else 0


def _described(tag: str, raw: str, parent: Element) -> Element:
    attrs = {k.lower(): unescape(v.strip("\"'")) for k, v in _ATTR.findall(raw)} if "=" in raw else {}
    classes = attrs.get("class", "").split()
    step = ".".join([tag, *sorted(_DIGITS.sub("#", c) for c in classes)])
    role = attrs.get("role", "").lower()
    hidden = parent.hidden or (attrs.get("aria-hidden") == "true" or bool(_HIDDEN.search(attrs.get("style", "")))
                               or bool(re.search(r"(?:^|\s)hidden(?:\s|/|>|$)", raw)))
    inside, article = parent.article, tag in ("article", "main") or role == "main"
    by_tag = min(TAG_MARKS.get(tag, 0.0), ROLE_MARKS.get(role, 0.0), STRONG if tag == "header" and not inside else 0.0)
    by_name = 0.0
    if not article and tag not in ("html", "body") and not (inside and re.fullmatch("h[1-6]", tag)):
        for name in classes if inside else (*classes, attrs.get("id", "")):
            words = _WORDS.findall(_CAMEL.sub(" ", name).lower())
            for i, w in enumerate(words):
                if i and words[i - 1] in NOT_OWN or inside and tag in INLINE and w in CODE_WORDS:
                    continue
                if w in STRONG_WORDS:
                    by_name = min(by_name, STRONG)
                elif w in MIDDLE_WORDS:
                    by_name = min(by_name, MIDDLE)
                elif w in WEAK_WORDS and not inside:
                    by_name = min(by_name, WEAK)
    return Element(tag, f"{parent.path}/{step}", parent, min(by_tag, by_name), by_tag == 0.0 > by_name, hidden,
                   inside or article)


def parse(html: str) -> tuple[list[Element], list[Block]]:
    """Elements and text blocks in page order. Elements know the words, link
    words and prose below them, and whether they hold the page's first article,
    main part or first-level heading."""
    elements: list[Element] = []
    blocks: list[Block] = []
    stack = [Element("", "", None, 0.0, False, False, False)]
    parts: list[str] = []
    owner, links, found = stack[0], 0, set()

    def flush():
        nonlocal links
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                blocks.append(Block(text, owner, links))
            parts.clear()
        links = 0

    def text(piece: str):
        nonlocal owner, links
        if not piece:
            return
        level = len(stack) - 1
        while level and stack[level].tag in INLINE:
            level -= 1
        above = stack[level + 1:]
        if any(e.hidden for e in above) or any(e.mark <= MIDDLE for e in above) and not (
                stack[-1].article and len(piece.split()) >= RUNNING):
            return  # furniture inside a line, such as a share link
        if not parts:
            owner = stack[level]
        if any(e.tag == "a" for e in above):
            links += len(piece.split())
        parts.append(piece)

    at, lower = 0, None
    while True:
        m = _MARK.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            level = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if tag not in INLINE:
                flush()
            if level:
                del stack[level:]
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            lower = html.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at) if len(lower) == len(html) else _find_end(html, tag, at)
            at = len(html) if end < 0 else end
            if end >= 0:
                close = html.find(">", end)
                at = len(html) if close < 0 else close + 1
            continue
        if tag not in INLINE:
            flush()
            top = len(stack) - 1
            while top and stack[top].tag in INLINE:
                top -= 1
            if top and (stack[top].tag == "p" or stack[top].tag in CLOSES.get(tag, ())):
                del stack[top:]
        element = _described(tag, m[3], stack[-1])
        stack.append(element)
        if tag not in INLINE:
            elements.append(element)
            kind = "article" if tag in ("article", "main") or element.article and not element.parent.article else tag
            if kind in ("article", "h1") and kind not in found and not element.hidden:
                found.add(kind)
                if kind == "article" or "article" not in found:
                    for e in element.up():
                        e.holds = True
    flush()
    for b in blocks:
        digest = hash_of(b.text)
        for e in b.owner.up():
            e.words += b.words
            e.links += b.links
            e.prose += b.prose
            e.digest = (e.digest * 31 + digest) & _LONG
    return elements, blocks


_LONG = (1 << 63) - 1


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little") >> 1


def score(e: Element, page_prose: int) -> float:
    """What speaks for (above 0) or against a marked element."""
    if e.hidden:
        return -math.inf
    out = e.mark + min(MOST_PROSE, math.log1p(e.prose / 10))
    if e.words:
        out -= 2 * max(0.0, e.links / e.words - 0.4) / 0.6
    if e.holds and (e.named or e.mark > STRONG):
        out += HOLDS_ARTICLE
    elif e.mark > STRONG and page_prose and e.prose >= 0.6 * page_prose:
        out += HOLDS_ARTICLE  # most of what the page says
    return out


def is_link_list(e: Element) -> bool:
    """An unmarked list or box of links outside an article."""
    return not e.article and not e.holds and e.tag in ("ul", "ol", "div", "table") and e.words > 0 \
        and e.links >= 3 and e.links >= 0.8 * e.words


def page_prose(elements: list[Element], blocks: list[Block]) -> int:
    """The prose that most of would speak for a marked element; none where the
    page itself names its article."""
    return 0 if any(e.holds for e in elements) else sum(b.prose for b in blocks)


def furniture(elements: list[Element], prose: int, host: "HostPaths | None" = None) -> set[int]:
    """Ids of the elements that are furniture themselves (not by a parent)."""
    out = set()
    for e in elements:
        if e.hidden or e.mark < 0:
            s = score(e, prose)
            if host is not None and abs(s) < OPEN:
                s += host.leaning(e)
            if s < 0 and not (host is not None and host.around(e.path) and e.mark > STRONG):
                out.add(id(e))
        elif is_link_list(e) or host is not None and host.repeats(e):
            out.add(id(e))
        if host is not None and e.mark < 0 and host.repeats(e):
            out.add(id(e))
    return out


def kept(blocks: list[Block], dropped: set[int]) -> list[Block]:
    known: dict[int, bool] = {}

    def gone(e: Element | None) -> bool:
        if e is None:
            return False
        if id(e) not in known:
            known[id(e)] = id(e) in dropped or gone(e.parent)
        return known[id(e)]
    return [b for b in blocks if not gone(b.owner)]


def good_blocks(elements: list[Element], blocks: list[Block], host: "HostPaths | None" = None) -> list[Block]:
    """The blocks that are not furniture. If class names and forms alone would
    take all of a page, they are ignored."""
    dropped = furniture(elements, page_prose(elements, blocks), host)
    good = kept(blocks, dropped)
    if any(b.prose for b in good):  # blocks of links alone, beside the text, lead elsewhere
        best = best_element(good)
        good = [b for b in good if b.links < b.words or b.owner.article or best in b.owner.up()]
    if not good and blocks:
        sure = {id(e) for e in elements if e.hidden or e.mark < 0 and not e.named and e.mark <= STRONG}
        rest = kept(blocks, sure)
        good = rest if any(b.prose for b in rest) or any("/h1" in b.owner.path for b in rest) else []
        if good and not any(b.prose for b in good):  # beside the heading
            top = next(b.owner.path.partition("/h1")[0] for b in good if "/h1" in b.owner.path)
            good = [b for b in good if _below(b.owner.path, top)]
    return good


def best_element(good: list[Block]) -> Element | None:
    """The container with the most prose: a block's words count for the
    containers around it, halved at each step out."""
    total: dict[int, float] = {}
    seen: dict[int, Element] = {}
    for b in good:
        share = float(b.prose or 0.1 * (b.words - b.links))
        for e in b.owner.up():
            if e.tag in CONTAINERS:
                seen[id(e)] = e
                total[id(e)] = total.get(id(e), 0.0) + share
                share /= 2
    return max(seen.values(), key=lambda e: (total[id(e)], -len(e.path), e.path)) if seen else None


def best_container(good: list[Block]) -> str:
    best = best_element(good)
    return best.path if best is not None else ""


def _below(path: str, top: str) -> bool:
    return path == top or path.startswith(f"{top}/")


class HostPaths:
    """What a host's pages agree on: its containers, the summed scores of its
    marked paths by sign, and the paths that repeat."""

    def __init__(self, containers, kept_marks, dropped_marks, repeated):
        self.containers = tuple(containers or ())
        self._lean = {**dict.fromkeys(kept_marks or (), OPEN), **dict.fromkeys(dropped_marks or (), -OPEN)}
        self._repeated = frozenset(repeated or ())

    def leaning(self, e: Element) -> float:
        return self._lean.get(e.path, 0.0)

    def around(self, path: str) -> bool:
        return any(_below(c, path) for c in self.containers)

    def repeats(self, e: Element) -> bool:
        if e.path not in self._repeated or e.holds or self.around(e.path):
            return False
        return e.mark < 0 or not any(_below(e.path, c) for c in self.containers)


def main_text(html: str, host: HostPaths | None = None) -> tuple[str, str]:
    """All text that is not furniture, and the page's best container."""
    good = good_blocks(*(page := parse(html)), host)
    return "\n".join(b.text for b in good), best_container(good)


def _find_end(html: str, tag: str, at: int) -> int:
    m = re.compile(f"</{tag}", re.I).search(html, at)
    return m.start() if m else -1


#: Kinds of votes: a page's best container, a marked element, any other element.
CONTAINER, MARKED, OTHER = 0, 1, 2
VOTES = ("host string, path string, kind int, pages long, lean double, first long, last long, "
         "first_page long, last_page long")


def page_votes(html: str) -> dict[tuple[str, int], tuple]:
    """(path, kind) -> (score, digest of what it says, digest of the page)."""
    elements, blocks = parse(html)
    prose = page_prose(elements, blocks)
    best = best_container(good_blocks(elements, blocks))
    whole = hash_of("\n".join(b.text for b in blocks))
    votes: dict[tuple[str, int], tuple] = {(best, CONTAINER): (0.0, 0, whole)} if best else {}
    for e in elements:
        if not e.words or e.hidden or e.holds:
            continue
        if e.mark < 0:
            lean, digest, _ = votes.get((e.path, MARKED), (0.0, 0, 0))
            votes[e.path, MARKED] = lean + max(-4.0, min(4.0, score(e, prose))), (digest * 31 + e.digest) & _LONG, whole
        elif not _below(e.path, best) and not _below(best, e.path):
            _, digest, _ = votes.get((e.path, OTHER), (0.0, 0, 0))
            votes[e.path, OTHER] = 0.0, (digest * 31 + e.digest) & _LONG, whole
    return votes


def _votes(batches):
    for batch in batches:
        sums: dict[tuple, list] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            for (path, kind), (lean, says, page) in page_votes(html.as_py() or "").items():
                v = sums.setdefault((host, path, kind), [0, 0.0, says, says, page, page])
                v[0] += 1
                v[1] += lean
                v[2], v[3] = min(v[2], says), max(v[3], says)
                v[4], v[5] = min(v[4], page), max(v[5], page)
        keys, values = list(sums), list(sums.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([v[0] for v in values], pa.int64()),
             pa.array([v[1] for v in values], pa.float64()), *[pa.array([v[i] for v in values], pa.int64()) for i in range(2, 6)]],
            names=["host", "path", "kind", "pages", "lean", "first", "last", "first_page", "last_page"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, containers, kept_marks, dropped_marks, repeated): what won on each
    host. A list holds paths that are on a fiftieth of the host's pages, so it has
    at most fifty times the paths of a page."""
    votes = cut(pages.select("host", "html").mapInArrow(_votes, VOTES).groupBy("host", "path", "kind").agg(
        F.sum("pages").alias("pages"), F.sum("lean").alias("lean"), F.min("first").alias("first"),
        F.max("last").alias("last"), F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page")),
        "html-votes")
    of_host = votes.where(F.col("kind") == CONTAINER).groupBy("host").agg(F.sum("pages").alias("all_pages"))
    usual = votes.join(of_host, "host").where(F.col("pages") >= ON_PAGES * F.col("all_pages"))
    same = (F.col("kind") != CONTAINER) & (F.col("pages") >= REPEATED) & (F.col("first") == F.col("last")) \
        & (F.col("first_page") != F.col("last_page"))

    def paths(chosen):
        return F.collect_list(F.when(chosen, F.col("path")))
    marked = (F.col("kind") == MARKED) & (F.col("pages") > 1)
    return usual.groupBy("host").agg(
        F.array_compact(F.array(F.max_by("path", F.when(F.col("kind") == CONTAINER, F.struct("pages", "path"))))).alias("containers"),
        paths(marked & (F.col("lean") > 0)).alias("kept_marks"),
        paths(marked & (F.col("lean") < 0)).alias("dropped_marks"), paths(same).alias("repeated"))


LISTS = ("containers", "kept_marks", "dropped_marks", "repeated")


def _extract(html: pa.Array, *lists: pa.Array) -> pa.Array:
    done, hosts = [], {}
    for h, *own in zip(html, *[x.to_pylist() for x in lists]):
        key = tuple(tuple(x or ()) for x in own)
        if key not in hosts:
            hosts[key] = HostPaths(*key)
        done.append(main_text(h.as_py() or "", hosts[key]))
    return pa.StructArray.from_arrays([pa.array([t for t, _ in done], pa.string()),
                                       pa.array([c for _, c in done], pa.string())], names=["text", "container"])


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, container."""
    host = F.regexp_extract(F.lower(F.col(url_col)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                      F.coalesce(host, F.lit("")).alias("host"), F.col(html_col).cast("string").alias("html"))
    winners = cut(host_paths(pages), "html-paths")
    length = sum((F.length(F.array_join(c, "/")) for c in LISTS), F.length("host"))
    if (winners.agg(F.sum(length)).first()[0] or 0) <= BROADCAST_BYTES:
        winners = F.broadcast(winners)
    joined = pages.join(winners, "host", "left")

    @F.arrow_udf("struct<text string, container string>")
    def extract(html: pa.Array, containers: pa.Array, kept_marks: pa.Array, dropped_marks: pa.Array,
                repeated: pa.Array) -> pa.Array:
        return _extract(html, containers, kept_marks, dropped_marks, repeated)

    found = joined.select("page_id", "url", extract("html", *LISTS).alias("x"))
    return found.select("page_id", "url", F.col("x.text").alias("text"),
                        F.char_length("x.text").cast("long").alias("n_chars"), F.col("x.container").alias("container"))
