"""Steps whose memory, work or shuffles must not grow faster than the input."""

import gc

import pandas as pd
from conftest import SF
from pyspark.sql import functions as F

from newsflow.operators import dom
from newsflow.operators import enrich as E
from newsflow.operators import rules as R
from newsflow.plans import bindings as B
from newsflow.plans import collect as C
from newsflow.plans import queries as Q
from newsflow.plans import site_pages as SP
from newsflow.sinks.json_sink import write_items_json


def test_json_lines_are_read_in_splits_and_in_file_order(spark, tmp_path):
    path = str(tmp_path / "json")
    rows = spark.range(4000).select(
        F.format_string("u%04d", "id").alias("uid"), F.concat(F.lit("a\nb\r"), F.repeat(F.lit("x"), (F.col("id") % 70).cast("int"))).alias("title"),
        F.lit(None).cast("string").alias("published_dt_str"))
    write_items_json(rows.repartitionByRange(3, "uid").sortWithinPartitions("uid"), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = Q.json_lines(spark, path).orderBy("rank").collect()
        assert spark.read.text(path).rdd.getNumPartitions() > 6  # files are split
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["rank"], r.uid) for r in got] == [(i + 1, f"u{i:04d}") for i in range(4000)]
    assert {r.n_keys for r in got} == {3} and got[5].title == "a\nb\r" + "x" * 5


def test_page_results_are_given_on_in_bounded_batches():
    html = "<article>" + "<p>text</p>" * 50_000 + "</article>"
    pages = pd.DataFrame({"page_id": range(20), "url": "https://eisamay.com/a", "html": html, "sites": [["eisamay"]] * 20})
    sizes = [len(out) for out in R._article_batches(iter([pages]))]
    assert sum(sizes) == 20 and max(sizes) < 10


def test_nodes_of_a_page_go_without_the_cycle_collector():
    pages = pd.DataFrame({"page_id": [1], "url": "u", "html": "<div class='a'><p>x<b>y</b></p></div>", "sites": [list(R.SITES)]})
    gc.collect()
    gc.disable()
    try:
        list(R._article_batches(iter([pages])))
        assert not [o for o in gc.get_objects() if isinstance(o, dom.Node)]
    finally:
        gc.enable()


def test_selection_is_in_page_order_and_inside_the_node():
    root = dom.parse("<div class='a b'><p>1<i>2</p>3</div><p class=a>4<div><p>5</p>6")
    assert [e.get_text("|") for e in root.select("p, .a")] == ["1|2|3", "1|2", "4|5|6", "5"]
    div = root.select("div")
    assert [e.get_text() for e in div[0].select("p")] == ["12"] and div[0].select_one(".a") is None
    assert div[1].select_one("p.a p").get_text() == "5" and div[1].get_text("|") == "5|6"


def test_model_batches_are_bounded_in_bytes(spark):
    def generate(req):
        return pd.DataFrame({"text": [str(len(req))] * len(req), "error": [None] * len(req)})
    text = F.lit("")
    items = spark.range(0, 100, 1, 1).select(
        F.col("id").cast("string").alias("uid"), F.repeat(F.lit("x"), 100_000).alias("title"),
        *(text.alias(c) for c in ("raw_summary", "full_text", "url", "source")))
    got = E.call_model(items, generate).select("text_one_line").collect()
    assert len(got) == 100 and max(int(r.text_one_line) for r in got) <= 40


def test_listings_of_one_file_are_dealt_to_all_cores(spark, monkeypatch):
    parts = {}
    for name in ("raw_site_cards", "extract_site_articles"):
        def spy(pages, name=name, made=getattr(R, name)):
            parts[name] = pages.rdd.getNumPartitions()
            return made(pages)
        monkeypatch.setattr(R, name, spy)
    rows = [(i, "https://eisamay.com/entertainment" if i % 2 else f"https://eisamay.com/{i}", "<p>x</p>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(C, "stage", lambda df, tag: df)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        C.site_parts(spark, pages)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert min(parts.values()) == 4


def test_an_insert_stages_no_wide_rows_of_its_own(spark, tmp_path, monkeypatch):
    staged, real = [], C.stage

    def spy(df, tag):
        staged.append(df.columns)
        return real(df, tag)
    monkeypatch.setattr(C, "stage", spy)
    items = real(B.doc_items(spark, SF), "items")
    added = C.insert(spark, str(tmp_path / "store"), items, B.run_ts(), "doc_id")
    assert added == items.select("uid").distinct().count()
    assert all(set(c) <= {"uid", "doc_id"} for c in staged)
    assert C.insert(spark, str(tmp_path / "store"), items, B.run_ts(), "doc_id") == 0


def test_a_run_of_model_answers_builds_its_items_once(spark, monkeypatch):
    calls, real = [], B.raw_store
    monkeypatch.setattr(B, "raw_store", lambda *a: calls.append(1) or real(*a))
    Q.REGISTRY["model_answers"](spark, SF)
    assert len(calls) == 1


def test_only_the_form_of_a_page_in_use_is_built(spark):
    plan = SP.crawled_pages(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at(map" not in plan and "element_at(array(concat" not in plan
