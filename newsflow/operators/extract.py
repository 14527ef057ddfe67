"""Native (JVM-side) extraction from raw pages.

Covers the generic page form (one ``<article>``, ``<h1>``/``<title>``,
``<p>`` paragraphs, ``<a href>`` links) with built-in expressions only, so
the whole path stays inside whole-stage codegen and needs no Python worker.
Pages with site-specific markup (classes, data attributes) go through the
rule path in :mod:`newsflow.operators.rules`.

Paragraph semantics follow a parsed tree that adds no implied end tags: an
unclosed ``<p>`` owns everything up to the end of its block, so its text
repeats the paragraphs nested in it (``nested=True``, the default);
``nested=False`` keeps each segment's own text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import (
    ATTRS_RE, NODE, _c, decode_entities, html_text, joined_nodes, let, mark, memo, node_string, py_strip, starts_with_ci,
    strip_non_text, text_nodes,
)
from newsflow.functions.urls import url_resolve
from newsflow.session import spread

# A start tag to its end; quoted values may hold '>'.
OPEN_A_RE = rf"<a(?:\s{ATTRS_RE}>|\s[^>]*>|>)"
ANCHOR_RE = rf"(?is){OPEN_A_RE}.*?(?:</a\s*>|$)"
IMG_RE = rf"(?is)<img(?:\s{ATTRS_RE}>|\s[^>]*>|>)"
PUBLISHED_LINE_RE = r"(?U)^[\s\x1c-\x1f]*Published:"
PUBLISHED_RE = r"(?Ud)Published:[\s\x1c-\x1f]*(.+)"


def unnest(df: DataFrame, columns: list, array: str, pos: str, value: str) -> DataFrame:
    """One row per element of ``array``: the columns, its position and itself.

    Written as an outer explode whose empty rows are dropped afterwards: for an
    inner one the optimizer adds a filter on the array's size and pushes it below
    the projections that compute the array, where all of them run once more for
    every use of a value.
    """
    return df.select(*columns, F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())


def _start_tag(tag: str) -> str:
    return rf"<{tag}(?:\s{ATTRS_RE}>|\s[^>]*>|/?>)"


def has_tag(clean, tag: str) -> Column:
    return _c(clean).rlike("(?i)" + _start_tag(tag))


def first_inner(clean, tag: str) -> Column:
    """Inner HTML of the first ``tag`` element ('' when absent); an unclosed
    element runs to the end of the document."""
    return F.regexp_extract(_c(clean), rf"(?is){_start_tag(tag)}(.*?)(?:</{tag}\s*>|$)", 1)


@memo
def raw_attr(tag_html, name: str) -> Column:
    """Value of attribute ``name`` in one start tag as written ('' if absent)."""
    other = r"""(?:"[^"]*"|'[^']*'|[^>"'])*?"""  # before it, quoted values are passed whole
    pat = rf"""(?is)^<[A-Za-z0-9]+\s(?:{other}\s)?{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    t = _c(tag_html)
    return F.concat(F.regexp_extract(t, pat, 1), F.regexp_extract(t, pat, 2), F.regexp_extract(t, pat, 3))


@memo
def attr_value(tag_html, name: str) -> Column:
    """Decoded value of attribute ``name`` in one start tag ('' if absent)."""
    return decode_entities(raw_attr(tag_html, name))


@memo
def title_fragment(clean) -> Column:
    """Inner HTML of the title chain ``h1 -> title`` (NULL when neither)."""
    return (F.when(has_tag(clean, "h1"), first_inner(clean, "h1"))
            .when(has_tag(clean, "title"), first_inner(clean, "title")))


@memo
def page_title(clean, sep: str = "") -> Column:
    """Title chain ``h1 -> title``; presence-based (an empty ``<h1>`` gives '')."""
    return let(title_fragment(clean), lambda frag: F.when(frag.isNotNull(), html_text(frag, sep)))


#: Tags that stay as marks in a page's node string.
MARKED = ("h1", "title", "article", "p")


def inner_nodes(nodes, name: str) -> Column:
    """Nodes of the first element ``name`` (NULL when absent); an unclosed one runs to the end."""
    n = _c(nodes)
    start = F.instr(n, mark(name))
    return F.when(start > 0, F.concat(F.lit(NODE), F.substring_index(F.substr(n, start + len(mark(name))), mark("/" + name), 1)))


@memo
def nodes_title(nodes, sep: str = "") -> Column:
    """:func:`page_title` from the page's node string."""
    return joined_nodes(F.coalesce(inner_nodes(nodes, "h1"), inner_nodes(nodes, "title")), sep)


@memo
def block_nodes(nodes) -> Column:
    """Nodes of the block chain ``article -> whole page`` from the page's node string."""
    return F.coalesce(inner_nodes(nodes, "article"), _c(nodes))


@memo
def paragraph_parts(block) -> Column:
    """Segments of a block's nodes split at every ``<p>`` (stage this as a column
    before :func:`raw_paragraphs` so it is computed once per row)."""
    return F.split(_c(block), mark("p"), -1)


@memo
def raw_paragraphs(parts, nested: bool = True) -> Column:
    """Text of every ``<p>`` in document order (unfiltered), from the staged
    ``paragraph_parts`` column.  The nodes are read already: a paragraph is a range
    of them, an unclosed one the range to the end of its block."""
    parts = _c(parts)
    n = F.size(parts)

    def one(seg, i):
        own = F.substring_index(seg, mark("/p"), 1)
        if not nested:
            return joined_nodes(own, " ")
        rest = F.array_join(F.slice(parts, i + 2, F.greatest(n - i - 1, F.lit(1))), "")
        return joined_nodes(F.when(F.instr(seg, mark("/p")) > 0, own).otherwise(rest), " ")

    return F.transform(F.slice(parts, 2, F.greatest(n - 1, F.lit(0))), one)


@memo
def keep_paragraphs(paras, drop_ads: bool = True) -> Column:
    """Drop empty paragraphs and, for sites with the ad rule, those starting
    with 'advertisement' (case-insensitive)."""
    if drop_ads:
        return F.filter(paras, lambda t: (t != "") & ~starts_with_ci(t, "advertisement"))
    return F.filter(paras, lambda t: t != "")


@memo
def byline_date(page_text) -> Column:
    """Rest of the line after the first ``Published:`` (stripped), else NULL."""
    txt = _c(page_text)
    return F.when(txt.rlike(PUBLISHED_RE), py_strip(F.regexp_extract(txt, PUBLISHED_RE, 1)))


@memo
def byline_author(lines) -> Column:
    """Author for the pattern ``<author> | <rest of line>`` followed by a
    line starting with ``Published:``; NULL when there is none.

    Equivalent to a leftmost regex search of
    ``([^\\n]+?)\\s*\\|\\s*[^\\n]*\\n\\s*Published:`` over the text, computed
    line by line from the staged ``split(page_text, '\\n')`` column so the
    cost stays linear in the text length (the backtracking regex is
    quadratic on long lines).  Three shapes match, each starting at the
    beginning of a line j:
    a) a '|' (not first char) in line j, ``Published:`` opens line j+1;
    c) line j ends with '|' (+ blanks), ``Published:`` opens line j+2;
    b) line j+1 opens with '|', ``Published:`` opens line j+2 (author =
       all of line j).
    The earliest line wins; on the same line a, then c, then b.
    """
    def search(lines):
        n = F.size(lines)
        idx = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
        pub = lambda k: F.coalesce(F.get(lines, k).rlike(PUBLISHED_LINE_RE), F.lit(False))
        line = lambda k: F.get(lines, k)
        first = lambda cond: F.get(F.filter(idx, cond), 0)
        ca = first(lambda j: (F.locate("|", line(j), 2) > 0) & pub(j + 1))
        cc = first(lambda j: line(j).rlike(r"(?U)^[^\n]+\|[\s\x1c-\x1f]*$") & pub(j + 2))
        cb = first(lambda j: (j >= 1) & (F.length(line(j - 1)) > 0)
                   & line(j).rlike(r"(?U)^[\s\x1c-\x1f]*\|") & pub(j + 1)) - 1

        def pick(r):
            ca, cc, cb = r["a"], r["c"], r["b"]
            key = F.least(ca * 3, cc * 3 + 1, cb * 3 + 2)
            la, lc = line(ca), line(cc)
            author_a = py_strip(F.substring(la, F.lit(1), F.locate("|", la, 2) - 1))
            last_bar = F.length(lc) - F.locate("|", F.reverse(lc)) + 1
            author_c = py_strip(F.substring(lc, F.lit(1), last_bar - 1))
            return (F.when(key.isNull(), F.lit(None).cast("string"))
                    .when(key == ca * 3, author_a)
                    .when(key == cc * 3 + 1, author_c)
                    .otherwise(py_strip(line(cb))))

        return let(F.struct(ca.alias("a"), cc.alias("c"), cb.alias("b")), pick)

    # blanks around the bar and before "Published:" may span blank lines
    return let(F.filter(_c(lines), lambda x: py_strip(x) != ""), search)


@memo
def first_img_tag(clean) -> Column:
    """Start tag of the first ``<img>`` ('' when none)."""
    return F.regexp_extract(_c(clean), f"({IMG_RE})", 1)


@memo
def img_src(tag, base) -> Column:
    """``src`` (else ``data-src``) of a staged img tag, resolved; NULL if none."""
    tag = _c(tag)
    src = decode_entities(F.coalesce(F.nullif(raw_attr(tag, "src"), F.lit("")), F.nullif(raw_attr(tag, "data-src"), F.lit(""))))
    base = _c(base)
    return let(src, lambda s: F.when(s.isNotNull(), url_resolve(base, py_strip(s))))


def extract_articles(pages: DataFrame, drop_ads: bool = True, nested: bool = True,
                     title_sep: str = "") -> DataFrame:
    """pages(page_id, url, html) -> (page_id, url, article_details struct).

    Narrow: one output row per page, no shuffle; ``html`` is dropped in the
    first projection.  Intermediate values are staged as columns so each is
    computed once per row (the optimizer keeps projections apart when an
    expensive value is used more than once).
    """
    s1 = spread(pages).select("page_id", "url", strip_non_text("html").alias("clean"))
    s1 = s1.select("page_id", "url", "clean", node_string("clean", *MARKED).alias("nodes"))
    s2 = s1.select(
        "page_id", "url",
        nodes_title("nodes", title_sep).alias("article_title"),
        paragraph_parts(block_nodes("nodes")).alias("parts"),
        joined_nodes("nodes", "\n").alias("page_text"),
        first_img_tag("clean").alias("img"))
    s3 = s2.select(
        "page_id", "url", "article_title", img_src("img", "url").alias("article_image_url"),
        keep_paragraphs(raw_paragraphs("parts", nested), drop_ads).alias("paras"),
        byline_date("page_text").alias("date"),
        F.split("page_text", "\n", -1).alias("lines"))
    details = F.struct(
        "article_title",
        F.get("paras", 0).alias("short_description"),
        "article_image_url",
        byline_author("lines").alias("author"),
        "date",
        F.when(F.size("paras") > 0, F.array_join("paras", "\n\n")).alias("full_text"))
    return s3.select("page_id", "url", details.alias("article_details"))


def extract_paragraphs(pages: DataFrame, drop_ads: bool = True, nested: bool = True) -> DataFrame:
    """One row per kept paragraph: (page_id, pos, text)."""
    s0 = spread(pages).select("page_id", strip_non_text("html").alias("clean"))
    s1 = s0.select("page_id", node_string("clean", *MARKED).alias("nodes"))
    s1 = s1.select("page_id", paragraph_parts(block_nodes("nodes")).alias("parts"))
    s2 = s1.select("page_id", keep_paragraphs(raw_paragraphs("parts", nested), drop_ads).alias("paras"))
    return (unnest(s2, ["page_id"], "paras", "pos", "text")
            .select("page_id", F.col("pos").cast("long").alias("pos"), "text"))


def _anchors(pages: DataFrame) -> DataFrame:
    return spread(pages).select("page_id", "url", F.regexp_extract_all(
        strip_non_text("html"), F.lit(ANCHOR_RE), 0).alias("anchors"))


def _href(anchor) -> Column:
    return attr_value(F.regexp_extract(anchor, rf"(?is)^({OPEN_A_RE})", 1), "href")


def link_cards(pages: DataFrame) -> DataFrame:
    """One row per ``<a>`` in page order: (page_id, url, pos, n_links, text, href).

    ``n_links`` is the listing size, computed per row (no window).
    """
    df = unnest(_anchors(pages), ["page_id", "url", F.size("anchors").cast("long").alias("n_links")], "anchors", "pos", "anchor")
    return df.select(
        "page_id", "url", F.col("pos").cast("long").alias("pos"), "n_links",
        html_text(F.regexp_extract("anchor", rf"(?is)^{OPEN_A_RE}(.*?)(?:</a\s*>)?$", 1), "")
        .alias("text"),
        _href("anchor").alias("href"))


def extract_links(pages: DataFrame) -> DataFrame:
    """Generic link cards: (page_id, pos, n_links, text, href, article_url);
    ``article_url`` is the href resolved against the page URL; a missing href
    resolves to the page itself."""
    return link_cards(pages).select("page_id", "pos", "n_links", "text", "href",
                     url_resolve("url", py_strip("href")).alias("article_url"))


def first_per_key(cards, key: str) -> Column:
    """The first element of each ``key`` in an array of structs, in array order.

    Sorted by (key, position) and compared with the neighbour, so a listing of
    n cards costs n log n steps.
    """
    c = _c(cards)
    keyed = F.array_sort(F.transform(c, lambda x, i: F.struct(x[key].alias("k"), i.alias("i"))))

    def firsts(ks):
        kept = F.filter(ks, lambda x, i: (i == 0) | ~F.get(ks, i - 1)["k"].eqNullSafe(x["k"]))
        return F.transform(F.array_sort(F.transform(kept, lambda x: x["i"])), lambda i: F.get(c, i))

    return let(keyed, firsts)


def dedup_listing(pages: DataFrame, repeat: bool = False) -> DataFrame:
    """Listing dedup (first card per resolved URL in page order wins).

    Done inside each listing row with array functions: no shuffle and no
    window, whatever the number of pages.  ``repeat=True`` appends a second
    copy of the listing (higher positions) to exercise the rule.
    """
    a = _anchors(pages)
    if repeat:
        a = a.withColumn("anchors", F.concat("anchors", "anchors"))
    hrefs = a.where(F.size("anchors") > 0).select(
        "page_id", "url", F.transform("anchors", lambda x: py_strip(_href(x))).alias("hrefs"))
    urls = hrefs.select("page_id", F.transform(
        "hrefs", lambda h: url_resolve(F.col("url"), h)).alias("urls"))
    cards = urls.select("page_id", F.arrays_zip(
        F.sequence(F.lit(0), F.size("urls") - 1).alias("pos"), F.col("urls").alias("article_url"))
        .alias("cards"))
    kept = cards.select("page_id", first_per_key("cards", "article_url").alias("kept"))
    return (unnest(kept, ["page_id"], "kept", "at", "c")
            .select("page_id", F.col("c.pos").cast("long").alias("pos"),
                    F.col("c.article_url").alias("article_url")))


def page_text_nodes(pages: DataFrame) -> DataFrame:
    """E15 surface: the three ``get_text`` modes of the whole page."""
    nodes = F.col("nodes")
    return spread(pages).select("page_id", text_nodes(strip_non_text("html")).alias("nodes")).select(
        "page_id",
        F.size(nodes).cast("long").alias("n_nodes"),
        F.array_join(nodes, "").alias("text_joined"),
        F.array_join(nodes, " ").alias("text_spaced"),
        F.array_join(nodes, "\n").alias("text_lines"))
