"""Bad pages, bad answers, hostile keys and interrupted writes stay where they are."""

import re
from html.entities import html5

import pandas as pd
from pyspark.sql import functions as F

from newsflow.functions.dates import parse_published
from newsflow.functions.text import decode_entities
from newsflow.operators import enrich as E
from newsflow.operators import extract as X
from newsflow.operators import items as I
from newsflow.operators import rules as R
from newsflow.operators import store as S

GOOD = "<h1>Title</h1><article><p>one</p><p>two</p></article>"


def test_references_to_no_character(spark):
    cases = {"&#9999999;": "�", "&#xD800;": "�", "&#0;": "�", "&#150;": "–", "&#0000000065;": "A",
             "&#99999999999999999999;": "�", "&#x1F600;": "\U0001f600", "a &amp;#65; b": "a &#65; b"}
    rows = spark.createDataFrame([(k,) for k in cases], "s string").select("s", decode_entities(F.col("s")).alias("t")).collect()
    assert {r.s: r.t for r in rows} == cases


def test_every_named_reference(spark):
    names = {n.rstrip(";"): c for n, c in html5.items()}
    rows = spark.createDataFrame([(n, f"x &{n}; y") for n in names], "n string, s string")
    got = {r.n: r.t for r in rows.select("n", decode_entities(F.col("s")).alias("t")).collect()}
    assert got == {n: f"x {c} y" for n, c in names.items()}
    odd = spark.createDataFrame([("caf&eacute; &rarr; &unknown; & &amp",)], "s string")
    assert odd.select(decode_entities(F.col("s"))).first()[0] == "café → &unknown; & &"


def test_bad_pages_leave_good_ones(spark):
    pages = spark.createDataFrame([(1, "http://a/1", GOOD), (2, "http://a/2", GOOD.replace("one", "&#xD800;&#9999999;")),
                                   (3, "http://a/3", "<p>one</p><![foo[x]]><p>two</p>")], "page_id long, url string, html string")
    native = {r.page_id: r for r in X.extract_articles(pages).collect()}
    assert set(native) == {1, 2, 3}
    rows = {r.page_id: r for r in R.extract_site_articles(pages.withColumn("site", F.lit("statesman"))).collect()}
    assert rows[1].parse_error is None and rows[2].parse_error is None
    assert rows[1].article_details.full_text.split() == ["one", "two"]
    whole = rows[3].article_details is not None and "two" in (rows[3].article_details.full_text or "")
    assert whole or rows[3].parse_error


def test_byline_over_blank_lines(spark):
    pattern = re.compile(r"([^\n]+?)\s*\|\s*[^\n]*\n\s*Published:")
    texts = ["A | Kolkata\n\nPublished: x", "A |\n\nKolkata\n\nPublished: x", "A\n\n| Kolkata\n \nPublished: x", "A | b\nc\nPublished: x"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("lines", F.split("t", "\n"))
    got = {r.t: r.a for r in frame.select("t", X.byline_author("lines").alias("a")).collect()}
    assert got == {t: (m.group(1).strip() if (m := pattern.search(t)) else None) for t in texts}


def test_date_forms(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    forms = {"December 2, 2025": "2025-12-02 00:00:00", "2 December 2025": "2025-12-02 00:00:00", "Dec 2, 2025 12:20 PM": "2025-12-02 12:20:00",
             "Tue, 02 Dec 2025 12:20:00 +0530": "2025-12-02 06:50:00", "12:20": None, "": None, "soon": None}
    frame = spark.createDataFrame([(k,) for k in forms], "s string")
    got = {r.s: r.t for r in frame.select("s", parse_published("s").cast("string").alias("t")).collect()}
    assert got == forms


def test_model_failure_stays_with_its_row(spark):
    def raises_on_b(req):
        if (req["uid"] == "b").any():
            raise RuntimeError("")
        return pd.DataFrame({"text": ["ok" if u != "c" else 7 for u in req["uid"]], "error": [None] * len(req)})

    raw = spark.createDataFrame([(u, "t", "s", "src", "http://x") for u in "abcd"],
                                "uid string, title string, raw_summary string, source string, url string").coalesce(1)
    got = {r.uid: r for r in E.enrich(raw, raises_on_b).collect()}
    assert {u: got[u].ai_mode for u in "abcd"} == {"a": "gemini", "b": "fallback", "c": "fallback", "d": "gemini"}
    assert got["b"].gemini_error is None and got["c"].gemini_error == "answer must be text, got int"


def test_dedup_takes_any_key_and_time(spark):
    rows = [("u", -5, "6000-01-01 00:00:00"), ("u", -9, "7000-01-01 00:00:00"), ("v", -1, None), ("v", -2, None), ("w", 2 ** 62, None)]
    items = spark.createDataFrame(rows, "uid string, k long, t string").withColumn("published_dt", F.col("t").cast("timestamp"))
    assert {r.uid: r.k for r in I.dedup_uid(items, "k").collect()} == {"u": -9, "v": -2, "w": 2 ** 62}
    keyed = items.withColumn("key", F.struct("k", "uid"))
    assert {r.uid: r.k for r in I.dedup_uid(keyed, "key").collect()} == {"u": -9, "v": -2, "w": 2 ** 62}


def test_an_aborted_snapshot_is_replaced(spark, tmp_path):
    root = str(tmp_path / "store")
    empty = spark.createDataFrame([], S.STORE_SCHEMA)
    first = S.write_snapshot(spark, root, empty)
    torn = tmp_path / "store" / f"n={first + 1}" / "kind=base" / "p=ab"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_text("half")
    assert S.read_store(spark, root).count() == 0
    assert S.write_snapshot(spark, root, empty) == first + 1
    assert S.read_store(spark, root).count() == 0
