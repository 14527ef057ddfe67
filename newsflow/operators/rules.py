"""Rule path: site-specific cards and articles extracted by declarative rules.

Each site is one rule row (selectors, attribute chains, URL base, flags).
The Python side is only the part Spark cannot express -- selecting nodes of
a parsed page by CSS rules and reading their text and attributes -- and it
runs inside ``mapInPandas`` (Arrow batches in, one row per page and site
out; ``html`` never leaves the task).  Everything after that is native:
URL resolution, protocol fix, blank cleaning, card filters, listing dedup,
paragraph filters, byline parsing and positions.  A page that cannot be
parsed yields a row with a ``parse_error`` text instead of failing the task.
"""

from __future__ import annotations

from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.text import memo, nbsp_clean, py_strip
from newsflow.functions.urls import fix_protocol, url_resolve
from newsflow.operators import dom
from newsflow.operators.extract import byline_author, byline_date, first_per_key, keep_paragraphs, unnest
from newsflow.session import bound_batches, ship_package, spread

# ---------------------------------------------------------------------------
# The three sites (base URL, listing URL, source label) and
# their selectors.  These must equal the sites' markup to extract anything.
# ---------------------------------------------------------------------------
SITES = {
    "bartaman": dict(
        label="Bartaman Binodon",
        base_url="https://bartamanpatrika.com",
        listing_url="https://bartamanpatrika.com/category/binodon",
        card=dict(
            container="div.col-md-4 > div.sg-post", inner=None,
            link=[".entry-content.catepage-grid a"], link_required=False,
            title_from="link", title_sep="",
            url_base="page",
            image=[".entry-header.catepage-img img"], image_in_link=False,
            image_attrs=["data-original", "src"], image_mode="urljoin", image_default=None,
            extras=[("category", ".category ul.global-list li a", "", "category_url")],
            author_nbsp=False, dedup=False),
        article=dict(
            title=["h3.entry-title.articletitle", "h1, h2, h3"], title_sep="",
            short="div.entry-content.shortdes p",
            image=[".entry-header .entry-thumbnail img", ".entry-thumbnail img"],
            image_attrs=["data-original", "src"], image_mode="urljoin",
            author=[".post-author .text h3"], author_sep="",
            date=[".post-author .text h6"], date_sep="", date_attr=None,
            byline_regex=False,
            block=None,
            block_pick=dict(selector="div.entry-content", want="p-4", avoid="shortdes",
                            inner="div.paragraph"),
            drop_ads=False),
    ),
    "statesman": dict(
        label="Dainik Statesman Binodan",
        base_url="https://www.dainikstatesmannews.com",
        listing_url="https://www.dainikstatesmannews.com/binodan/",
        card=dict(
            container="div.col-md-4", inner="div.post-block-style",
            link=[".post-content h3.post-title a"], link_required=False,
            title_from="link", title_sep="",
            url_base="site",
            image=[".post-thumb img"], image_in_link=False,
            image_attrs=["src"], image_mode="urljoin", image_default=None,
            extras=[("author", ".post-meta .post-author", " ", None),
                    ("read_time", ".post-meta .post-date", " ", None)],
            author_nbsp=True, dedup=False),
        article=dict(
            title=["h1.entry-title", "h1.post-title", "h1", "title"], title_sep="",
            short=None,
            image=["article .post-thumb img", ".single-post-thumb img", "img.wp-post-image"],
            image_attrs=["src"], image_mode="urljoin",
            author=None, author_sep=" ", date=None, date_sep=" ", date_attr=None,
            byline_regex=True,
            block=["article div.entry-content", "article", "div.entry-content"],
            block_pick=None,
            drop_ads=True),
    ),
    "eisamay": dict(
        label="Eisamay Entertainment",
        base_url="https://eisamay.com",
        listing_url="https://eisamay.com/entertainment",
        card=dict(
            container='[data-test-id="story-card"]', inner=None,
            link=['[data-test-id="arr--hero-image"]', "a[href]"], link_required=True,
            title_from=['[data-test-id="headline"] h2', '[data-test-id="headline"] h6',
                        '[data-test-id="headline"]'], title_sep=" ",
            url_base="site",
            image=None, image_in_link=True,
            image_attrs=["src", "data-src"], image_mode="fix_protocol", image_default="",
            extras=[("listing_subheadline", '[data-test-id="subheadline"]', " ", None)],
            author_nbsp=False, dedup=True),
        article=dict(
            title=["h1.headline-m_headline__3_NhV", "h1", "title"], title_sep=" ",
            short=None,
            image=["[data-test-id='arr--hero-image'] img", "figure img.qt-image", "img"],
            image_attrs=["src", "data-src"], image_mode="fix_protocol",
            author=["[data-test-id='author-name']", ".author-name", ".author"], author_sep=" ",
            date=["time", "[data-test-id='timestamp']", "span.time", "span.date"], date_sep=" ",
            date_attr="datetime",
            byline_regex=False,
            block=["[data-test-id='article-body']", "div.article-body", "article"],
            block_pick=None,
            drop_ads=True),
    ),
}

CARD_FIELDS = ["title", "article_url", "card_image_url", "category", "category_url",
               "author", "read_time", "listing_subheadline"]
CARD_SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("site", T.StringType()),
     T.StructField("card_pos", T.LongType()), T.StructField("n_cards", T.LongType())]
    + [T.StructField(f, T.StringType()) for f in CARD_FIELDS])
DETAIL_FIELDS = ["article_title", "short_description", "article_image_url", "author", "date",
                 "full_text"]

RAW_CARD = T.StructType([
    T.StructField("has_link", T.BooleanType()), T.StructField("href", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("img", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("category_href", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("read_time", T.StringType()),
    T.StructField("listing_subheadline", T.StringType())])
RAW_CARDS_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("site", T.StringType()), T.StructField("cards", T.ArrayType(RAW_CARD)),
    T.StructField("parse_error", T.StringType())])
RAW_ARTICLE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("site", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("short", T.StringType()), T.StructField("img", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("paragraphs", T.ArrayType(T.StringType())),
    T.StructField("page_text", T.StringType()), T.StructField("parse_error", T.StringType())])


# ---------------------------------------------------------------------------
# Python side: node selection and raw text / attribute values only
# ---------------------------------------------------------------------------
def _first(root, selectors):
    for sel in selectors or ():
        hit = root.select_one(sel)
        if hit is not None:
            return hit
    return None


def _attr_chain(tag, attrs):
    if tag is None:
        return None
    for a in attrs:
        v = tag.get(a)
        if v:
            return v
    return None


def raw_cards(root, site):
    """Raw card values of one parsed listing page, in page order."""
    rule = SITES[site]["card"]
    out = []
    for node in root.select(rule["container"]):
        card = node.select_one(rule["inner"]) if rule["inner"] else node
        if card is None:
            continue
        link = _first(card, rule["link"][:1])
        if link is None and len(rule["link"]) > 1:
            link = card.find("a", href=True)
        row = dict.fromkeys(RAW_CARD.fieldNames())
        row["has_link"] = link is not None
        if link is not None:
            row["href"] = link.get("href") or ""
        if rule["title_from"] == "link":
            if link is not None:
                row["title"] = link.get_text(rule["title_sep"], strip=True)
        else:
            head = _first(card, rule["title_from"])
            row["title"] = head.get_text(rule["title_sep"], strip=True) if head is not None else None
        img = (link.select_one("img") if link is not None else None) if rule["image_in_link"] \
            else _first(card, rule["image"])
        row["img"] = _attr_chain(img, rule["image_attrs"])
        for field, sel, sep, url_field in rule["extras"]:
            tag = card.select_one(sel)
            if tag is not None:
                row[field] = tag.get_text(sep, strip=True)
                if url_field:
                    row["category_href"] = tag.get("href", "")
        out.append(row)
    return out


def _block(root, rule):
    """The node that holds the article's paragraphs: the best ranked of the
    candidates that the site's rule selects (a fitting class, then the second
    candidate, then the first)."""
    pick = rule["block_pick"]
    if not pick:
        return _first(root, rule["block"]) or root

    def rank(entry):
        place, node = entry
        if pick["want"] in node.classes and pick["avoid"] not in node.classes:
            return 0, place
        return (1, 0) if place == 1 else (2, place)

    ranked = sorted(enumerate(root.select(pick["selector"])), key=rank)
    if not ranked:
        return None
    best = ranked[0][1]
    return best.select_one(pick["inner"]) or best


def raw_article(root, site):
    """Raw values of one parsed article page: texts and attributes of the
    nodes the site rule selects, paragraphs unfiltered."""
    rule = SITES[site]["article"]
    title_tag = _first(root, rule["title"])
    block = _block(root, rule)
    out = {
        "title": title_tag.get_text(rule["title_sep"], strip=True) if title_tag is not None else None,
        "short": None, "author": None, "date": None, "page_text": None,
        "img": _attr_chain(_first(root, rule["image"]), rule["image_attrs"]),
        "paragraphs": [p.get_text(" ", strip=True) for p in block.find_all("p")]
        if block is not None else [],
    }
    if rule["short"]:
        tag = root.select_one(rule["short"])
        out["short"] = tag.get_text(" ", strip=True) if tag is not None else None
    if rule["byline_regex"]:
        out["page_text"] = root.get_text("\n", strip=True)
    else:
        a = _first(root, rule["author"])
        out["author"] = a.get_text(rule["author_sep"], strip=True) if a is not None else None
        d = _first(root, rule["date"])
        if d is not None:
            out["date"] = (d.get(rule["date_attr"]) if rule["date_attr"] else None) or \
                d.get_text(rule["date_sep"], strip=True)
    return out


#: Characters of pages whose results are held at a time.
BATCH_CHARS = 4 << 20


def _applied(extract, failed, schema):
    """Arrow batches of pages -> one row per page and site, given on in bounded batches."""
    keys = schema.fieldNames()

    def run(it):
        rows, size = [], 0
        for pdf in it:
            for pid, url, html, sites in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["sites"]):
                root = None
                for site in sites:
                    try:
                        root = root if root is not None else dom.parse(html)
                        row = {**extract(root, site), "parse_error": None}
                    except Exception as e:  # noqa: BLE001 - isolate the page
                        row = {**failed, "parse_error": repr(e)}
                    rows.append({**dict.fromkeys(keys), "page_id": pid, "url": url, "site": site, **row})
                if root is not None:
                    root.release()
                size += len(html or "") * len(sites)
                if size > BATCH_CHARS:
                    yield pd.DataFrame(rows, columns=keys)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=keys)
    return run


_card_batches = _applied(lambda root, site: {"cards": raw_cards(root, site)}, {"cards": []}, RAW_CARDS_SCHEMA)
_article_batches = _applied(raw_article, {"paragraphs": []}, RAW_ARTICLE_SCHEMA)


# ---------------------------------------------------------------------------
# Spark side: everything after node selection
# ---------------------------------------------------------------------------
def _by_site(values: dict, default=None):
    """CASE site WHEN ... from per-site Column values."""
    expr = None
    for site, v in values.items():
        expr = F.when(F.col("site") == site, v) if expr is None else expr.when(F.col("site") == site, v)
    return expr.otherwise(default) if default is not None else expr


def _truthy(c):
    return c.isNotNull() & (c != "")


def _with_sites(pages: DataFrame) -> DataFrame:
    """Input rows carry either one ``site`` or an array ``sites``; each page
    is parsed once and every listed rule is applied to the same tree."""
    ship_package(pages.sparkSession)
    bound_batches(pages.sparkSession)
    sites = F.col("sites") if "sites" in pages.columns else F.array(F.col("site"))
    return spread(pages.select("page_id", "url", "html", sites.alias("sites")))


def raw_site_cards(pages: DataFrame) -> DataFrame:
    """(page_id, url, site, cards: array of raw card values, parse_error)."""
    return _with_sites(pages).mapInPandas(_card_batches, RAW_CARDS_SCHEMA)


@memo
def _card_exprs():
    """(card transform, required flag, dedup flag) -- built once per driver."""
    base = F.col("_base")

    def card(c):
        href = py_strip(F.coalesce(c["href"], F.lit("")))
        img_join = F.when(_truthy(c["img"]), url_resolve(base, py_strip(c["img"])))
        img_fix = F.when(_truthy(c["img"]), fix_protocol(c["img"])).otherwise(F.lit(""))
        return F.struct(
            c["has_link"].alias("has_link"), href.alias("href"),
            c["title"].alias("title"),
            F.when(c["has_link"], url_resolve(base, href)).alias("article_url"),
            _by_site({s: (img_fix if r["card"]["image_mode"] == "fix_protocol" else img_join)
                      for s, r in SITES.items()}).alias("card_image_url"),
            c["category"].alias("category"),
            F.when(c["category"].isNotNull(),
                   url_resolve(base, py_strip(F.coalesce(c["category_href"], F.lit("")))))
            .alias("category_url"),
            _by_site({s: (nbsp_clean(c["author"]) if r["card"]["author_nbsp"] else c["author"])
                      for s, r in SITES.items()}).alias("author"),
            c["read_time"].alias("read_time"),
            c["listing_subheadline"].alias("listing_subheadline"))

    return (F.transform("cards", card),
            _by_site({s: (F.col("url") if r["card"]["url_base"] == "page" else F.lit(r["base_url"]))
                      for s, r in SITES.items()}),
            _by_site({s: F.lit(r["card"]["link_required"]) for s, r in SITES.items()}),
            _by_site({s: F.lit(r["card"]["dedup"]) for s, r in SITES.items()}))


def finish_cards(raw: DataFrame) -> DataFrame:
    """Raw listing values -> cards, per-row and shuffle-free.

    Cards without a link are dropped for the site that requires one (a hero
    link with an empty href too); URLs are resolved against the page URL or
    the site base; the listing dedup (first card per URL in page order)
    runs on the card array of each listing; positions count kept cards.
    """
    cards, base, required, dedup = _card_exprs()
    x = raw.where(F.col("parse_error").isNull()).withColumn("_base", base)
    x = x.select("page_id", "site", cards.alias("c"), required.alias("_req"), dedup.alias("_dd"))
    x = x.select("page_id", "site", "_dd", F.filter(
        "c", lambda c: ~F.col("_req") | (c["has_link"] & (c["href"] != ""))).alias("c"))
    x = x.select("page_id", "site", F.when(F.col("_dd"), first_per_key("c", "article_url")).otherwise(F.col("c")).alias("c"))
    x = unnest(x, ["page_id", "site", F.size("c").cast("long").alias("n_cards")], "c", "card_pos", "k")
    return x.select("page_id", "site", F.col("card_pos").cast("long").alias("card_pos"), "n_cards",
                    *[F.col("k")[f].alias(f) for f in CARD_FIELDS])


def extract_cards(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html, site|sites) -> one row per card."""
    return finish_cards(raw_site_cards(pages))


def raw_site_articles(pages: DataFrame) -> DataFrame:
    return _with_sites(pages).mapInPandas(_article_batches, RAW_ARTICLE_SCHEMA)


@memo
def _article_exprs():
    """(paragraph filter, details struct) -- built once per driver."""
    ads = _by_site({s: F.lit(r["article"]["drop_ads"]) for s, r in SITES.items()})
    paras = F.when(ads, keep_paragraphs("paragraphs", True)).otherwise(
        keep_paragraphs("paragraphs", False))
    img = F.col("img")
    image = _by_site({s: (F.when(_truthy(img), fix_protocol(img))
                          if r["article"]["image_mode"] == "fix_protocol"
                          else F.when(_truthy(img), url_resolve(F.col("url"), py_strip(img))))
                      for s, r in SITES.items()})
    regex = _by_site({s: F.lit(r["article"]["byline_regex"]) for s, r in SITES.items()})
    short = _by_site({s: (F.col("short") if r["article"]["short"] else F.get(F.col("paras"), 0))
                      for s, r in SITES.items()})
    details = F.struct(
        F.col("title").alias("article_title"),
        short.alias("short_description"),
        image.alias("article_image_url"),
        F.when(regex, byline_author("lines")).otherwise(F.col("author")).alias("author"),
        F.when(regex, byline_date("page_text")).otherwise(F.col("date")).alias("date"),
        F.when(F.size("paras") > 0, F.array_join("paras", "\n\n")).alias("full_text"))
    return paras, details


def finish_articles(raw: DataFrame) -> DataFrame:
    """Raw article values -> (page_id, site, url, article_details, parse_error)."""
    paras, details = _article_exprs()
    x = raw.select("*", paras.alias("paras"), F.split("page_text", "\n", -1).alias("lines"))
    return x.select("page_id", "site", "url",
                    F.when(F.col("parse_error").isNull(), details).alias("article_details"),
                    "parse_error")


def extract_site_articles(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html, site|sites) -> one details row per page and site."""
    return finish_articles(raw_site_articles(pages))


#: Type of ``article_details``.
DETAILS_TYPE = T.StructType([T.StructField(f, T.StringType()) for f in DETAIL_FIELDS])


def rule_host(base_url: str) -> str:
    """The host under which a site's rule is kept: without ``www.``."""
    return urlsplit(base_url).hostname.removeprefix("www.")


def path_of(url: str) -> str:
    return urlsplit(url).path.rstrip("/")


def longest_suffix(host: Column, values: dict[str, str]) -> Column:
    """The value of the longest suffix of the host's labels among the keys; NULL for none."""
    known = F.create_map(*(F.lit(x) for kv in values.items() for x in kv))
    labels = F.split(host, r"\.", -1)
    found = F.transform(labels, lambda _, i: F.try_element_at(known, F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))
    return F.get(F.filter(found, lambda v: v.isNotNull()), 0)


def site_rules_frame(spark) -> DataFrame:
    """The 3-row site dimension (fixed size: safe to broadcast)."""
    rows = [(k, v["label"], v["base_url"], v["listing_url"],
             v["article"]["drop_ads"], v["card"]["dedup"]) for k, v in SITES.items()]
    return spark.createDataFrame(
        rows, "site string, source string, base_url string, feed_url string, "
              "drop_ads boolean, listing_dedup boolean")
