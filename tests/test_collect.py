"""End-to-end collector and processor runs on golden site pages."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators import items as I
from newsflow.operators import store as S
from newsflow.operators.rules import SITES
from newsflow.plans import collect as C
from newsflow.plans.bindings import run_ts
from newsflow.plans.stub import stub_generate
from test_rules import SITE3_LISTING, SITE2_LISTING

ES = SITES["eisamay"]
DS = SITES["statesman"]

ARTICLE_1 = """<html><head><title>T1</title></head><body><h1>Article one</h1>
<time datetime="2025-12-02T06:50:00Z">x</time><div data-test-id="article-body">
<p>Advertisement</p><p>First.</p><p>Second.</p></div></body></html>"""
ARTICLE_DS = """<html><body><h1 class="entry-title">Statesman story</h1>
<p>Someone | Kolkata</p><p>Published: December 2, 2025 12:20 pm</p>
<article><div class="entry-content"><p>Body.</p></div></article></body></html>"""


def _pages(spark):
    rows = [
        (1, ES["listing_url"], SITE3_LISTING),
        (2, ES["base_url"] + "/ent/1", ARTICLE_1),
        # /ent/2 has no page: the card stays with NULL details
        (3, DS["listing_url"], SITE2_LISTING),
        (4, DS["base_url"] + "/binodan/x", ARTICLE_DS),
        (5, "https://elsewhere.example/a", "<h1>other host</h1>"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_collect_then_process(spark, tmp_path):
    root = str(tmp_path / "store")
    items = {r.link: r for r in C.site_items(spark, _pages(spark)).collect()}
    one = items[ES["base_url"] + "/ent/1"]
    assert one.title == "Article one" and one.source == ES["label"]
    assert one.summary_raw == "First."
    assert one.media_url == "https://media.x/1.jpg"  # card image (article has none)
    assert one.published_dt_str == "2025-12-02T06:50:00+0000"
    two = items[ES["base_url"] + "/ent/2"]
    assert two.title == "Second" and two.summary_raw == ""  # no article, no subheadline
    ds = items[DS["base_url"] + "/binodan/x"]
    assert ds.title == "Statesman story" and ds.published == "December 2, 2025 12:20 pm"
    assert ds.published_dt_str == "2025-12-02T12:20:00+0000"
    assert items[DS["base_url"]].title == "No href"  # missing href -> base URL, kept
    stats = C.collect(spark, _pages(spark), root, run_ts()).first()
    n_uids = len({r.uid for r in items.values()})
    assert (stats.added, stats.skipped) == (n_uids, len(items) - n_uids)
    again = C.collect(spark, _pages(spark), root, run_ts()).first()
    assert again.added == 0
    assert (stats.quarantined, again.quarantined) == (1, 1)
    assert [tuple(r) for r in C.read_quarantine(spark, root).select("page_id", "site", "reason").distinct().collect()] == [
        (5, None, "no site rule")]
    done = C.process(spark, root, stub_generate, run_ts()).first()
    st = S.read_store(spark, root)
    assert (done.ready, done.error) == (stats.added, 0)
    assert st.where(F.col("status") == "raw").count() == 0
    assert st.count() == stats.added
    # processing again changes nothing: no row is raw any more
    before = sorted(map(tuple, st.select("uid", "status", "summary", "ai_mode").collect()))
    C.process(spark, root, stub_generate, run_ts())
    after = S.read_store(spark, root)
    assert sorted(map(tuple, after.select("uid", "status", "summary", "ai_mode").collect())) == before


def _log_calls(folder, stop=""):
    """A model that notes every call in ``folder`` and kills its worker at the title ``stop``."""
    def generate(req):
        import os
        import time
        import uuid
        for uid, kind, prompt in zip(req["uid"], req["kind"], req["prompt"]):
            if stop and f"Title: {stop}\n" in prompt:
                time.sleep(6)  # the other tasks end first
                os._exit(1)
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(f"{uid} {kind}")
        return stub_generate(req)
    return generate


def test_a_killed_process_repeats_no_call(spark, tmp_path):
    import os
    import pytest
    root, calls = str(tmp_path / "store"), str(tmp_path / "calls")
    os.mkdir(calls)
    C.collect(spark, _pages(spark), root, run_ts())
    titles = sorted(r.title for r in S.read_store(spark, root).collect())
    with pytest.raises(Exception):
        C.process(spark, root, _log_calls(calls, titles[0]), run_ts(), partitions=32)
    assert S.read_raw(spark, root).count() == len(titles) and os.listdir(calls)
    done = C.process(spark, root, _log_calls(calls), run_ts(), partitions=32).first()
    assert done.ready == len(titles)
    made = [open(f"{calls}/{f}").read() for f in os.listdir(calls)]
    assert len(made) == len(set(made))  # none twice
    assert sum("one_line" in m for m in made) == len(titles)
    before = len(made)
    assert C.process(spark, root, _log_calls(calls), run_ts()).first().ready == 0 and len(os.listdir(calls)) == before


def test_hosts_belong_to_the_longest_suffix(spark):
    hosts = {"https://www.eisamay.com/entertainment": ("eisamay", "listing"), "https://m.eisamay.com/entertainment/": ("eisamay", "listing"),
             "http://user:pw@EISAMAY.com:8080/x": ("eisamay", "article"), "https://noteisamay.com/x": (None, None),
             "https://eisamay.com.evil.example/entertainment": (None, None), "relative/path": (None, None), "https://com/": (None, None)}
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(hosts)] + [(99, None, "")], "page_id long, url string, html string")
    got = {r.url: (r.site, r.role) for r in C.assign_sites(pages).collect()}
    assert got == hosts | {None: (None, None)}


def test_runs_leave_no_staged_tables(spark, tmp_path):
    import os
    from newsflow.session import checkpoint_root
    folder = checkpoint_root(spark)
    before = set(os.listdir(folder))
    C.collect(spark, _pages(spark), str(tmp_path / "store"), run_ts())
    C.process(spark, str(tmp_path / "store"), stub_generate, run_ts())
    assert set(os.listdir(folder)) == before


def test_a_run_holds_each_text_once(spark, tmp_path, monkeypatch):
    import os
    import random
    from newsflow.session import checkpoint_root
    words = random.Random(1)
    texts = ["".join(chr(words.randrange(0x4E00, 0x9FFF)) for _ in range(20_000)) for _ in range(12)]
    card = '<div data-test-id="story-card"><a data-test-id="arr--hero-image" href="/n/{0}"></a><div data-test-id="headline"><h6>T{0}</h6></div></div>'
    pages = [(99, ES["listing_url"], "".join(card.format(i) for i in range(12)))]
    pages += [(i, f"{ES['base_url']}/n/{i}", f"<article><p>{t}</p></article>") for i, t in enumerate(texts)]
    folder, held, real = checkpoint_root(spark), [], S.append_store
    before = {d for d, _, _ in os.walk(folder)}

    def spy(*a):
        held.append(sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) if d not in before for f in names))
        return real(*a)
    monkeypatch.setattr(S, "append_store", spy)
    read = []
    root = str(tmp_path / "store")
    C.collect(spark, spark.createDataFrame(pages, "page_id long, url string, html string"), root, run_ts(), pages_read=lambda: read.append(len(held)))
    assert sorted(r.full_text for r in S.read_store(spark, root).collect()) == sorted(texts)
    # a text is one paragraph, so it is the summary and the full text of its item
    assert held[0] < 2.5 * sum(len(t.encode()) for t in texts)
    assert read == [0]


def _parts(spark):
    """Cards and staged articles with odd rows: an article page twice, of two contents; one article of many cards; cards without an article."""
    from newsflow.operators import rules as R
    from newsflow.session import stage
    url = "https://eisamay.com/{}".format
    cards = [(1, "eisamay", i, 9, f"t{i}", url(u), None, None, None, None, None, f"sub{i}") for i, u in enumerate(
        ["a", "b", "none", "blank", "", *["hot"] * 100, *["gone"] * 20])] + [(1, "eisamay", 0, 9, "t0", url("a"), None, None, None, None, None, "other"),
        (2, "statesman", 0, 1, None, url("b"), "i", None, None, None, None, "no"), (2, "statesman", 1, 1, "n", None, "i", None, None, None, None, "no")]
    details = [(1, url("a"), ("A", "s1", None, "x", "2025-01-01", "one")), (1, url("a"), ("A", "s2", "i", "x", "2025-01-02", "two")),
               (2, url("a"), ("later", "s", "i", "x", None, "later")), (3, url("b"), (" ", "", "", None, "", None)),
               (4, url("blank"), ("", "  ", None, None, None, " z ")), (5, url("hot"), ("", "s", None, None, None, "hot")), (6, None, ("N", "n", None, None, None, "n"))]
    arts = spark.createDataFrame(details, T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                                                        T.StructField("article_details", R.DETAILS_TYPE)]))
    return spark.createDataFrame(cards, R.CARD_SCHEMA), stage(arts.repartition(3).withColumn("row", F.monotonically_increasing_id()), "articles")


def test_long_fields_come_back_as_they_were(spark):
    cards, arts = _parts(spark)
    whole = C.joined_items(spark, I.join_cards_articles(cards, I.unique_articles(arts), hot=True))
    light = C.joined_items(spark, I.join_cards_articles(cards, I.unique_articles(I.without_long_fields(arts)), hot=True))
    assert {r.full_text for r in light.collect()} == {""}
    got = I.join_long_fields(light, arts, "row_key", C.subheadline())
    assert got.dtypes == whole.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_items_without_an_article_are_dealt_evenly(spark):
    import statistics
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}
    _, arts = _parts(spark)
    none = F.lit(None).cast(I.without_long_fields(arts).schema["article_details"].dataType)
    items = spark.range(8000).select(F.col("id").alias("row_key"), F.lit("eisamay").alias("site"), F.lit("s").alias("listing_subheadline"), none.alias("article_details"),
                                     F.lit("").alias("summary_raw"), F.lit("").alias("full_text"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = I.join_long_fields(items, arts, "row_key", C.subheadline())
        dealt = [r["count"] for r in got.where("summary_raw = 's' and article_details is null").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(dealt) == 8000 and max(dealt) < 2 * statistics.median(dealt)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_the_export_holds_whole_items(spark, tmp_path):
    C.collect(spark, _pages(spark), str(tmp_path / "store"), run_ts(), json_path=str(tmp_path / "json"))
    want = C.site_items(spark, _pages(spark)).drop("published_dt", "row_key")
    want = sorted(want.toJSON().collect(), key=str)
    got = spark.read.schema(C.site_items(spark, _pages(spark)).drop("published_dt", "row_key").schema).json(str(tmp_path / "json"))
    assert sorted(got.toJSON().collect(), key=str) == want
    assert any(r.article_details and r.article_details.full_text for r in got.collect())


def test_shuffle_files_go_with_the_write(spark):
    import time
    from newsflow.session import FREE_SHUFFLES, stage
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = disk.getAllBlocks()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}
    before, old = shuffles(), spark.conf.get(FREE_SHUFFLES, None)
    got = stage(spark.range(1000).repartition(5, "id"), "dealt")
    for _ in range(50):
        if left := shuffles() - before:
            time.sleep(0.1)
    assert not left and got.count() == 1000
    assert spark.conf.get(FREE_SHUFFLES, None) == old


def test_the_query_keeps_no_crawled_pages(spark):
    import os
    from conftest import SF
    from newsflow.plans import queries as Q
    from newsflow.session import checkpoint_root
    before = set(os.listdir(checkpoint_root(spark)))
    assert Q.REGISTRY["collect_run"](spark, SF).count() > 0
    assert not [f for f in set(os.listdir(checkpoint_root(spark))) - before if f.startswith("crawl-")]


def test_listings_shuffle_no_paragraphs(spark):
    from conftest import SF
    from newsflow.plans import site_pages as SP
    plan = SP.listing_pages(SP.site_docs(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    left = plan.split("Join LeftOuter")[1].split(":  +- ")[0]  # what the documents' side brings to the join with the dates
    assert left.count(" AS ") == 2 and " AS title#" in left and " AS second#" in left


def test_the_quarantine_needs_no_pages_once_they_are_read(spark, tmp_path):
    import os
    from newsflow.session import checkpoint_root, release, stage
    root, before = str(tmp_path / "store"), set(os.listdir(checkpoint_root(spark)))
    pages = stage(_pages(spark).unionByName(spark.createDataFrame([(6, ES["listing_url"], "<![foo[x]]>"), (7, None, None)], "page_id long, url string, html string")), "landed")
    done = C.collect(spark, pages, root, run_ts(), pages_read=lambda: release(pages)).first()
    assert set(os.listdir(checkpoint_root(spark))) == before
    lost = {(r.page_id, r.reason) for r in C.read_quarantine(spark, root).collect()}
    assert lost == {(5, "no site rule"), (6, "parse error"), (7, "no site rule")} and done.quarantined == 3


def test_the_quarantine_query_keeps_no_crawled_pages(spark):
    import os
    from conftest import SF
    from newsflow.plans import queries as Q
    from newsflow.session import checkpoint_root
    before = set(os.listdir(checkpoint_root(spark)))
    lost = Q.REGISTRY["collect_quarantine"](spark, SF)
    assert {r.reason for r in lost.select("reason").distinct().collect()} == {"no site rule", "parse error"}
    assert not [f for f in set(os.listdir(checkpoint_root(spark))) - before if f.startswith("crawl-")]
