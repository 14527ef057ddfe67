import re

import pytest
from pyspark.sql import functions as F

from conftest import SF
from newsflow.operators import extract as EX
from newsflow.operators.rules import extract_site_articles

AUTHOR_RE = re.compile(r"([^\n]+?)\s*\|\s*[^\n]*\n\s*Published:")
DATE_RE = re.compile(r"Published:\s*(.+)")


def test_native_article_equals_parsed_tree(spark):
    """The native path equals the rule path (statesman profile) on every page."""
    from pyspark.sql import functions as F
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    native = {r.page_id: r.article_details.asDict()
              for r in EX.extract_articles(pages).collect()}
    rule = {r.page_id: r.article_details.asDict() for r in extract_site_articles(
        pages.withColumn("site", F.lit("statesman"))).collect()}
    assert native == rule


def test_nested_paragraphs(spark):
    html = ("<html><head><title>T</title><script>var t=\"</p>\";</script></head><body>"
            "<article><h1>Head <b>line</b></h1><p><b>A &amp; B<br><p>C</p><p> </p>"
            "<p>Advertisement x</p><p>D</p></article></body></html>")
    df = spark.createDataFrame([(1, "https://a.com/x", html)], "page_id long, url string, html string")
    d = EX.extract_articles(df).first().article_details
    assert d.article_title == "Headline"
    assert d.full_text == "A & B C Advertisement x D\n\nC\n\nD"
    assert d.short_description == "A & B C Advertisement x D"
    r = extract_site_articles(df.withColumn("site", F.lit("statesman"))).first().article_details
    assert d == r


BYLINES = [
    "Title\nSome Author | Kolkata\nPublished: December 2, 2025 12:20 pm\nBody",
    "Title\nA | b | c\nPublished:\nnext line",
    "x | y |\nmiddle\nPublished: z",
    "Name\n| Kolkata\nPublished: q",
    "|lead\nPublished: q",
    "no byline here",
    "a | b\nc\nPublished: late",
    "one | two\nPublished: ",
    "Published:",
    "a |  \nx\nPublished: y",
    "\u3000| z\nPublished: y",
    "lead | x\n\xa0Published: d",
]


def test_author_lines_vs_regex_on_documents(spark):
    """Line form == the reference regex on whole document texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    v = docs.select("doc_id", F.explode(F.array(
        F.col("text"),
        F.concat(F.regexp_replace("text", r"\\. ", " | "), F.lit("\nPublished: x")))).alias("t"))
    rows = v.select("t", EX.byline_author(F.split("t", "\n", -1)).alias("a")).collect()
    for r in rows:
        m = AUTHOR_RE.search(r.t)
        assert r.a == (m.group(1).strip() if m else None)


@pytest.mark.parametrize("text", BYLINES)
def test_byline_matches_regex(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(EX.byline_date("t").alias("d"),
                  EX.byline_author(F.split("t", "\n", -1)).alias("a")).first()
    m = AUTHOR_RE.search(text)
    assert r.a == (m.group(1).strip() if m else None)
    m = DATE_RE.search(text)
    assert r.d == (m.group(1).strip() if m else None)


def test_links_and_listing_dedup(spark):
    html = ('<nav><a href="/a">A</a><a href="/b?x=1&amp;y=2">B</a><a href="/a">A2</a>'
            '<a>none</a></nav>')
    df = spark.createDataFrame([(1, "https://h.com/p/q?z", html)], "page_id long, url string, html string")
    links = EX.extract_links(df).orderBy("pos").collect()
    assert [l.article_url for l in links] == ["https://h.com/a", "https://h.com/b?x=1&y=2",
                                              "https://h.com/a", "https://h.com/p/q?z"]
    assert {l.n_links for l in links} == {4}
    d = EX.dedup_listing(df).orderBy("pos").collect()
    assert [x.pos for x in d] == [0, 1, 3]


ODD = ['<p title="a > b">one</p><p class=x>two</p>', "<p data-x='1 > 0' id=\"q\">one</p><a title='x>y' href=\"/z?a>b\">t</a>",
       "<p it's>one</p><p class='x'>two</p>", "<p a=b\"c>one</p><p>two \"quoted\" > text</p>", "<p>1 < 2 > 0</p><p>a<b class=\"x>y\">c</b>d</p>",
       "<P>Upper<ARTICLE x=\">\"><p>in</p></article><p>out", "<h1 title=\"&gt;>\">T</h1><p>&lt;p&gt; &amp;lt; &#38;amp; &copy 1 &copy; &nbsp;</p>",
       "<p>one<p>two<p>three</p>four", "\x00<p>a\x00b</p>\x01p\x00", "<p>﷐ &amp;quot; &quot;</p>", "<p\n class=\"a\nb>\"\n>one</p>"]


def test_quoted_attributes_and_odd_pages_as_the_tokenizer_reads_them(spark):
    """The native path against the parsed tree: paragraphs, title and all text nodes."""
    from newsflow.operators import rules as R
    pages = spark.createDataFrame([(i, "http://a/", h) for i, h in enumerate(ODD)], "page_id long, url string, html string")
    native = {r.page_id: r for r in EX.extract_articles(pages).collect()}
    tree = {r.page_id: r for r in R.extract_site_articles(pages.withColumn("site", F.lit("statesman"))).collect()}
    for i, html in enumerate(ODD):
        if "\x00" in html:
            assert native[i].article_details.full_text == "a�b"  # a NUL is no character of a text
            continue
        for field in ("article_title", "full_text", "short_description"):
            assert native[i].article_details[field] == tree[i].article_details[field], (html, field)
    links = {r.page_id: r for r in EX.extract_links(pages).collect()}
    assert (links[1].href, links[1].text) == ("/z?a>b", "t")


def test_unclosed_paragraphs_are_read_once(spark):
    n = 1000
    html = "<article>" + "".join(f"<p><b>w{i}</b>" for i in range(n)) + "</article>"
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [r.text for r in EX.extract_paragraphs(pages).orderBy("pos").collect()]
    assert got == [" ".join(f"w{j}" for j in range(i, n)) for i in range(n)]
    plan = EX.extract_paragraphs(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("|<![^>]*>|") == 1  # one replacement reads all tags of a page
    assert EX.extract_paragraphs(pages, nested=False).where("pos = 7").first().text == "w7"
