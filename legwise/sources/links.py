"""Link extraction from a table of listing pages.

The reference scrapes one listing page; here every page of a ``pages`` table
is scanned in parallel: ``<a href="...">`` values are extracted with a regex,
filtered (A1/A2, optional), resolved against the page URL, de-duplicated and
sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.sources.files import name_matches, year_allowed

# Comments and scripts hold no links; attributes may stand in any order, case and quoting.
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
HREF = r"""(?is)<a\s(?:[^>"']|"[^"]*"|'[^']*')*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
# Character references that are common in addresses; the ampersand comes last.
REFERENCES = (("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"), ("&lt;", "<"),
              ("&gt;", ">"), ("&nbsp;", "\u00a0"), ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&"))
SCHEME_HOST = r"^([a-zA-Z][a-zA-Z0-9+.-]*):(//[^/?#]*)?"


def decoded(value) -> Column:
    """Attribute text with its character references resolved."""
    out = F.col(value) if isinstance(value, str) else value
    for reference, char in REFERENCES:
        out = F.replace(out, F.lit(reference), F.lit(char))
    return out


def without_dots(path: Column) -> Column:
    """A path that begins with a slash, with ``.`` and ``..`` folded and empty
    parts inside left out."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    inside = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda p: p != "")

    def fold(done: Column, p: Column) -> Column:
        return (F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
                .when(p == ".", done).otherwise(F.array_append(done, p)))
    folded = F.aggregate(F.concat(inside, F.array(last)), F.array().cast("array<string>"), fold)
    ends = F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    return F.concat(F.lit("/"), F.array_join(ends, "/"))


def resolve_url(base, href) -> Column:
    """``urljoin``: absolute, ``//host``, ``/path``, ``?query``,
    ``#fragment`` and relative paths, with ``.`` and ``..`` folded."""
    base, href = (F.col(base) if isinstance(base, str) else base), (F.col(href) if isinstance(href, str) else href)
    scheme = F.regexp_extract(base, SCHEME_HOST, 1)
    origin = F.concat(scheme, F.lit(":"), F.regexp_extract(base, SCHEME_HOST, 2))
    no_frag = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    base_path = F.regexp_replace(no_query, SCHEME_HOST, "")
    directory = F.regexp_replace(F.when(base_path == "", "/").otherwise(base_path), "[^/]*$", "")
    path, tail = F.regexp_extract(href, "^([^?#]*)", 1), F.regexp_extract(href, "^[^?#]*(.*)$", 1)
    return (F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(origin, without_dots(path), tail))
            .when(href.startswith("?"), F.concat(no_query, href))
            .when(href.startswith("#"), F.concat(no_frag, href))
            .when(href == "", base)
            .otherwise(F.concat(origin, without_dots(F.concat(directory, path)), tail)))


def extract_links(pages: DataFrame, html_col: str = "html", base_col: str = "url",
                  substring: str | None = None, suffix: str | None = None, only_years=None) -> DataFrame:
    """A3: sorted distinct absolute URLs linked from the pages (one column ``url``)."""
    markup = F.regexp_replace(F.col(html_col), NOT_MARKUP, "")
    found = pages.select(F.col(base_col).alias("_base"),
                         F.explode(F.regexp_extract_all(markup, F.lit(HREF), 1)).alias("href"))
    hrefs = found.withColumn("href", F.btrim(decoded(F.regexp_replace("href", "^[\"']|[\"']$", ""))))
    if substring is not None or suffix is not None:
        hrefs = hrefs.filter(name_matches("href", substring or "", suffix or ""))
    hrefs = hrefs.filter(year_allowed("href", only_years))
    return hrefs.select(resolve_url("_base", "href").alias("url")).distinct().orderBy("url")
