"""``documents`` rendered in the markup of the three sites.

Every document is one article page and one listing card of the site that its id
picks; its form (0 to 3) picks which of the site's alternatives the page uses, so
every field, the block rules and most selector alternatives are reached.  Listings hold
the cards of sixty consecutive ids.  Cards of form 2 have no link target, those of form 0
follow a card without any link, every twentieth article page is broken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.text import first_line, line_at
from newsflow.operators import rules as R
from newsflow.plans import bindings as B

#: Markup that ends the parse of a page with an error.
BROKEN_DECLARATION = "<p>one</p><![foo[x]]>"
LISTING_IDS = 60
#: Hosts that belong to a site (its own, ``www.``, a subdomain, another case, a port) and hosts that only look like one.
HOSTS = ["bartamanpatrika.com", "www.bartamanpatrika.com", "epaper.bartamanpatrika.com:443", "notbartamanpatrika.com",
         "dainikstatesmannews.com", "WWW.DainikStatesmanNews.com", "eisamay.com", "m.eisamay.com", "eisamay.com.example.org"]


def escaped(c: Column) -> Column:
    for plain, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(reference))
    return c


def _cat(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _form(*variants) -> Column:
    """The variant at the row's form; the others are not computed (each may hold a whole text).
    A negative form counts from the end, as an array's index would."""
    form, out = F.col("form"), F.when(F.col("form") == -1, F.raise_error(F.lit("no variant at index 0")))
    for k, v in enumerate(variants):
        out = out.when(form.isin(k, k - len(variants) - 1), _cat(*v) if isinstance(v, tuple) else _cat(v))
    return out


def _site(values: dict) -> Column:
    out = F  # the first ``when`` starts the chain
    for site, v in values.items():
        out = out.when(F.col("site") == site, _cat(v))
    return out


def site_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its site, form and escaped parts."""
    d = B.table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    lines = F.transform(F.split("text", "\n", -1), lambda x: _cat("<p>", escaped(x), "</p>"))
    # cut before the join: listings move no paragraphs
    d = d.select("doc_id", escaped(first_line("text")).alias("title"),
                 escaped(F.coalesce(line_at("text", 1), F.lit(""))).alias("second"),
                 escaped(F.col("source")).alias("source"), "lang", F.array_join(lines, "").alias("paras"))
    d = d.join(B.doc_published(spark, sf_dir), "doc_id", "left")
    return d.select(
        "doc_id", F.expr("cast((doc_id div 3) % 4 as int)").alias("form"),
        F.element_at(F.array(*map(F.lit, R.SITES)), (F.col("doc_id") % 3 + 1).cast("int")).alias("site"),
        F.col("doc_id").cast("string").alias("id"), "title", "second", "source", "lang",
        escaped(F.coalesce("published_src", F.lit(""))).alias("pub"), "paras")


def _article() -> dict:
    i, t, second, src, lang, pub, paras = map(F.col, ("id", "title", "second", "source", "lang", "pub", "paras"))
    heading = ("<h3 class='entry-title articletitle'>", t, "</h3>")
    short = ('<div class="entry-content shortdes"><p>', second, "</p></div>")

    def thumb(attribute):
        return (f'<div class="entry-header"><div class="entry-thumbnail"><img {attribute}="/img/', i, '.jpg"></div></div>')
    bartaman = _cat(
        _form(heading, ("<h2>", t, "</h2>"), heading, heading),
        _form(thumb("data-original"), thumb("data-original"), thumb("src"), ""),
        '<div class="post-author"><div class="text"><h3>', src, "</h3><h6>", pub, "</h6></div></div>",
        _form((*short, '<div class="entry-content p-4"><p>aside</p><div class="paragraph">', paras, "</div></div>"),
              (*short, '<div class="entry-content">', paras, "</div>"),
              ('<div class="entry-content">', paras, "</div>"),
              ('<div class="entry-content p-4 shortdes"><p>', second, '</p></div><div class="entry-content"><p>aside</p></div>'
               '<div class="entry-content p-4">', paras, "</div>")))
    picture = ('<img src="img/', i, '.jpg">')
    statesman = _cat(
        _form(('<h1 class="entry-title">', t, "</h1>"), ('<h1 class="post-title">', t, "</h1>"), ("<h1>", t, "</h1>"),
              ("<title>", t, "</title>")),
        "<div>", src, " | ", F.upper(lang), "</div><div>Published: ", pub, "</div>",
        _form(('<article><div class="post-thumb">', *picture, '</div><div class="entry-content">', paras, "</div></article>"),
              ('<article><div class="post-thumb">', *picture, '</div><div class="entry-content">', paras, "</div></article>"),
              ('<div class="single-post-thumb">', *picture, "</div><article>", paras, "</article>"),
              ('<div class="entry-content">', paras, "</div>")))
    eisamay = _cat(
        _form(('<h1>aside</h1><h1 class="headline-m_headline__3_NhV">', t, "</h1>"), ("<h1>", t, "</h1>"),
              ("<h1>", t, "</h1>"), ("<title>", t, "</title>")),
        _form(('<div data-test-id="arr--hero-image"><img src="//cdn.example/', i, '.jpg"></div>'),
              ('<figure><img class="qt-image" data-src="https://cdn.example/', i, '.jpg"></figure>'),
              ('<img src="//cdn.example/', i, '.jpg">'), ""),
        _form(('<span data-test-id="author-name">', src, "</span>"), ('<span class="author-name">', src, "</span>"),
              ('<span class="author">', src, "</span>"), ""),
        _form(('<time datetime="', pub, '">', lang, "</time>"), ('<span data-test-id="timestamp">', pub, "</span>"),
              ('<span class="time">', pub, "</span>"), ('<span class="date">', pub, "</span>")),
        _form(('<p>aside</p><div data-test-id="article-body">', paras, "</div>"),
              ('<div class="article-body">', paras, "</div>"), ("<article>", paras, "</article>"), paras))
    return {"bartaman": bartaman, "statesman": statesman, "eisamay": eisamay}


def article_pages(docs: DataFrame) -> DataFrame:
    """(page_id, site, url, html) of each row of :func:`site_docs`."""
    broken = F.when(F.col("doc_id") % 20 == 0, BROKEN_DECLARATION).otherwise("")
    url = _cat(_site({s: r["base_url"] for s, r in R.SITES.items()}), "/doc/", F.col("id"))
    return docs.select((F.col("doc_id") * 2).alias("page_id"), "site", url.alias("url"),
                       _cat("<html><body>", broken, _site(_article()), "</body></html>").alias("html"))


def _card() -> dict:
    i, t, second = F.col("id"), F.col("title"), F.col("second")
    link = ('<a href="/doc/', i, '">', t, "</a>")
    any_link = _form(link, link, ("<a>", t, "</a>"), link)
    bartaman = _cat(
        '<div class="col-md-4"><div class="sg-post"><div class="entry-header catepage-img">',
        _form(*[('<img data-original="/img/', i, '.jpg">')] * 2, ('<img src="/img/', i, '.jpg">'), ""),
        '</div><div class="entry-content catepage-grid">', any_link, "</div></div></div>")
    statesman = _cat(
        _form("", "", "", '<div class="col-md-4"></div>'),
        '<div class="col-md-4"><div class="post-block-style"><div class="post-thumb">',
        _form(*[('<img src="/img/', i, '.jpg">')] * 3, ""),
        '</div><div class="post-content"><h3 class="post-title">', any_link, "</h3></div></div></div>")
    image = ('<img src="//cdn.example/card/', i, '.jpg"></a>')
    eisamay = _cat(
        '<div data-test-id="story-card">',
        _form(('<a data-test-id="arr--hero-image" href="/doc/', i, '">', *image), ('<a href="/doc/', i, '">', *image), "",
              ('<a data-test-id="arr--hero-image" href="/doc/', i, '"></a>')),
        '<div data-test-id="headline"><h6>', t, '</h6></div><div data-test-id="subheadline">', second, "</div></div>")
    return {"bartaman": bartaman, "statesman": statesman, "eisamay": eisamay}


#: Cards without any link, which the collector drops.
LINKLESS = {"bartaman": '<div class="col-md-4"><div class="sg-post"><div class="entry-content catepage-grid">text</div></div></div>',
            "statesman": '<div class="col-md-4"><div class="post-block-style"><div class="post-content">text</div></div></div>',
            "eisamay": '<div data-test-id="story-card"><div data-test-id="headline"><h6>text</h6></div></div>'}


def listing_pages(docs: DataFrame, broken: bool = False) -> DataFrame:
    """Listing pages: at most ``LISTING_IDS`` documents each, cards of form 1 twice;
    with ``broken``, every seventh cannot be read."""
    card = _cat(F.when(F.col("form") == 0, _site(LINKLESS)).otherwise(""), _site(_card()))
    cards = docs.select("site", F.expr(f"doc_id div {LISTING_IDS}").alias("block"), "doc_id",
                        F.when(F.col("form") == 1, F.concat(card, card)).otherwise(card).alias("card"))
    made = cards.groupBy("site", "block").agg(F.array_sort(F.collect_list(F.struct("doc_id", "card"))).alias("cards"))
    number = _site({s: str(k) for k, s in enumerate(R.SITES)}).cast("long")
    return made.select(
        ((F.col("block") * 3 + number) * 2 + 1).alias("page_id"), "site",
        _site({s: r["listing_url"] for s, r in R.SITES.items()}).alias("url"),
        _cat("<html><body>", F.when(F.lit(broken) & (F.col("block") % 7 == 3), BROKEN_DECLARATION).otherwise(""),
             F.array_join("cards.card", ""), "</body></html>").alias("html"))


def crawled_pages(spark: SparkSession, sf_dir: str, broken_listings: bool = False) -> DataFrame:
    """(page_id, url, html): all listings and articles."""
    docs = site_docs(spark, sf_dir)
    return listing_pages(docs, broken_listings).unionByName(article_pages(docs)).select("page_id", "url", "html")
