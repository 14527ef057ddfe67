"""Golden pages (own invented text) for the three site rule rows."""

import pytest

from newsflow.operators.rules import SITES, extract_cards, extract_site_articles


@pytest.fixture(scope="module")
def run(spark):
    def cards(html, url, site):
        df = spark.createDataFrame([(1, url, html, site)],
                                   "page_id long, url string, html string, site string")
        return [r.asDict() for r in extract_cards(df).orderBy("card_pos").collect()]

    def article(html, url, site):
        df = spark.createDataFrame([(1, url, html, site)],
                                   "page_id long, url string, html string, site string")
        return extract_site_articles(df).first().article_details.asDict()
    return cards, article

SITE1_LISTING = """
<div class="row">
 <div class="col-md-4"><div class="sg-post">
  <div class="entry-header catepage-img"><img data-original="/img/a.jpg" src="/lazy.gif"></div>
  <div class="entry-content catepage-grid"><a href="/news/a"> Star <b>returns</b> </a></div>
  <div class="category"><ul class="global-list"><li><a href="/category/film">Film</a></li></ul></div>
 </div></div>
 <div class="col-md-4"><div class="sg-post">
  <div class="entry-header catepage-img"><img src="/img/b.jpg"></div>
 </div></div>
 <div class="col-md-4"><div class="sg-post">
  <div class="entry-content catepage-grid"><a href="c"> Third </a></div>
 </div></div>
</div>"""

SITE1_ARTICLE = """
<h3 class="entry-title articletitle">Big <i>news</i></h3>
<div class="entry-content shortdes"><p> Short  desc </p></div>
<div class="entry-header"><div class="entry-thumbnail"><img src="/img/main.jpg"></div></div>
<div class="post-author"><div class="text"><h3>Writer</h3><h6>2 December 2025</h6></div></div>
<div class="entry-content p-4"><div class="paragraph">
 <p>First para.</p><p>Advertisement kept here</p><p>  </p><p>Last.</p></div></div>"""

SITE1_FALLBACK = """
<div class="entry-content"><p>one</p></div><div class="entry-content"><p>two</p></div>"""

SITE2_LISTING = """
<div class="col-md-4">an empty column</div>
<div class="col-md-4"><div class="post-block-style">
 <p class="post-thumb"><img src="/img/x.jpg"></p>
 <div class="post-content"><h3 class="post-title">See: <a href="/binodan/x"> Title X </a></h3>
 <p class="post-meta"><b class="post-author"> By&nbsp;Someone&nbsp;Here </b><i class="post-date"> four minutes </i></p></div></div></div>
<div class="col-md-4"><div class="post-block-style">
 <div class="post-content"><h3 class="post-title"><a>No href</a></h3></div></div></div>"""

SITE2_ARTICLE = """<html><head><title>Page title</title></head><body>
<h1 class="entry-title">Head<b>Line</b></h1>
<div>Some Author | Kolkata</div><div>Published: December 2, 2025 12:20 pm</div>
<article><div class="post-thumb"><img src="/up/1.jpg"></div>
<div class="entry-content"><p>Advertisement</p><p>Body one.</p><p>Body two.</p></div></article>
</body></html>"""

SITE2_NOBYLINE = "<article><h1>Plain</h1><p>Only text.</p></article>"

SITE3_LISTING = """
<div data-test-id="story-card"><a data-test-id="arr--hero-image" href="/ent/1"><img src="//media.x/1.jpg"></a>
 <div data-test-id="headline"><a><h2>Lead story</h2></a></div>
 <div data-test-id="subheadline">Sub one</div></div>
<div data-test-id="story-card"><a data-test-id="arr--hero-image" href="/ent/1"><img src="//media.x/dup.jpg"></a>
 <div data-test-id="headline"><a><h6>Dup</h6></a></div></div>
<div data-test-id="story-card"><a href="/ent/2"><img data-src="//media.x/2.jpg"></a>
 <div data-test-id="headline"><a><h6>Second</h6></a></div></div>
<div data-test-id="story-card"><a data-test-id="arr--hero-image"><img src="//media.x/3.jpg"></a>
 <a href="/ent/3">other link</a><div data-test-id="headline">Third</div></div>"""

SITE3_ARTICLE = """<html><head><title>Fallback title</title></head><body><h1></h1>
<span class="author-name">Reporter</span><time datetime="2025-12-02T06:50:00Z">2 Dec</time>
<figure><img class="qt-image" src="//media.x/hero.jpg"></figure>
<div data-test-id="article-body"><p>ADVERTISEMENT</p><p>Para one</p><p>Para two</p></div>
</body></html>"""


def test_site1_cards(run):
    cards_from_html, article_from_html = run
    cards = cards_from_html(SITE1_LISTING, "https://site1.example/category/film", "bartaman")
    assert len(cards) == 3
    assert cards[0]["title"] == "Starreturns"
    assert cards[0]["article_url"] == "https://site1.example/news/a"
    assert cards[0]["card_image_url"] == "https://site1.example/img/a.jpg"
    assert cards[0]["category"] == "Film"
    assert cards[0]["category_url"] == "https://site1.example/category/film"
    assert cards[1]["title"] is None and cards[1]["article_url"] is None
    assert cards[2]["article_url"] == "https://site1.example/category/c"


def test_site1_article_keeps_ads_and_picks_block(run):
    cards_from_html, article_from_html = run
    d = article_from_html(SITE1_ARTICLE, "https://site1.example/news/a", "bartaman")
    assert d["article_title"] == "Bignews"
    assert d["short_description"] == "Short  desc"
    assert d["article_image_url"] == "https://site1.example/img/main.jpg"
    assert (d["author"], d["date"]) == ("Writer", "2 December 2025")
    assert d["full_text"] == "First para.\n\nAdvertisement kept here\n\nLast."
    d2 = article_from_html(SITE1_FALLBACK, "https://site1.example/x", "bartaman")
    assert d2["full_text"] == "two"
    d3 = article_from_html('<div class="entry-content"><p>only</p></div>', "https://s/x", "bartaman")
    assert d3["full_text"] == "only"


def test_site2_cards(run):
    cards_from_html, article_from_html = run
    cards = cards_from_html(SITE2_LISTING, "https://ignored/", "statesman")
    base = SITES["statesman"]["base_url"]
    assert len(cards) == 2
    assert cards[0]["title"] == "Title X"
    assert cards[0]["article_url"] == base + "/binodan/x"
    assert cards[0]["card_image_url"] == base + "/img/x.jpg"
    assert cards[0]["author"] == "By Someone Here"
    assert cards[0]["read_time"] == "four minutes"
    assert cards[1]["article_url"] == base  # missing href resolves to the base


def test_site2_article_byline_and_ads(run):
    cards_from_html, article_from_html = run
    d = article_from_html(SITE2_ARTICLE, "https://site2.example/binodan/x", "statesman")
    assert d["article_title"] == "HeadLine"
    assert d["author"] == "Some Author"
    assert d["date"] == "December 2, 2025 12:20 pm"
    assert d["full_text"] == "Body one.\n\nBody two."
    assert d["short_description"] == "Body one."
    assert d["article_image_url"] == "https://site2.example/up/1.jpg"
    d2 = article_from_html(SITE2_NOBYLINE, "https://s/x", "statesman")
    assert d2["author"] is None and d2["date"] is None


def test_site3_cards_dedup_and_protocol(run):
    cards_from_html, article_from_html = run
    cards = cards_from_html(SITE3_LISTING, "https://ignored/", "eisamay")
    base = SITES["eisamay"]["base_url"]
    assert [c["article_url"] for c in cards] == [base + "/ent/1", base + "/ent/2"]
    assert cards[0]["card_image_url"] == "https://media.x/1.jpg"
    assert cards[0]["title"] == "Lead story" and cards[0]["listing_subheadline"] == "Sub one"
    assert cards[1]["card_image_url"] == "https://media.x/2.jpg"
    assert cards[1]["title"] == "Second"


def test_site3_article(run):
    cards_from_html, article_from_html = run
    d = article_from_html(SITE3_ARTICLE, "https://site3.example/ent/1", "eisamay")
    assert d["article_title"] == ""           # empty <h1> is found: no fallback
    assert d["author"] == "Reporter"
    assert d["date"] == "2025-12-02T06:50:00Z"
    assert d["article_image_url"] == "https://media.x/hero.jpg"
    assert d["full_text"] == "Para one\n\nPara two"


def test_broken_pages_do_not_fail(spark):
    rows = [(1, "https://a/x", "", "statesman"), (2, "https://a/y", "not html at all <<<", "eisamay"),
            (3, "https://a/z", "<div><p>unclosed <b>tags", "bartaman"), (4, "https://a/w", None, "statesman")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, site string")
    out = extract_site_articles(df).orderBy("page_id").collect()
    assert len(out) == 4
    assert all(r.parse_error is None for r in out)
    assert out[0].article_details.full_text is None
    cards = extract_cards(df).collect()
    assert cards == []
