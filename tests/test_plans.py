"""Plan checks: the physical strategy the operators are meant to get."""

from conftest import SF
from pyspark.sql import functions as F
from newsflow.operators import items as I
from newsflow.operators import store as S
from newsflow.plans import bindings as B
from newsflow.plans.queries import REGISTRY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_aggregates_narrow_columns_by_hash(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(I.dedup_uid(B.doc_items(spark, SF), "doc_id"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "partial_min" in p and "HashAggregate" in p
    assert p.count("Exchange hashpartitioning(uid") == 1  # one aggregate finds the winners
    assert "SortAggregate" not in p
    assert "ShuffledHashJoin" not in p  # no forced build side that cannot spill


def test_insert_does_not_shuffle_store(spark):
    batch = I.dedup_uid(B.doc_items(spark, SF), "doc_id")
    p = plan(S.insert_new(batch, B.existing_store(spark, SF)))
    assert "BroadcastHashJoin" in p


def test_top_k_is_take_ordered(spark):
    p = plan(REGISTRY["top_headlines"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_scan_prunes_columns(spark):
    p = plan(REGISTRY["page_scan"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in p
    p = plan(REGISTRY["make_uid"](spark, SF))
    assert "lang" not in p.split("ReadSchema")[1].split("\n")[0]


def test_store_scan_pushes_status_filter(spark, tmp_path):
    root = str(tmp_path / "s")
    S.write_snapshot(spark, root, B.existing_store(spark, SF))
    from pyspark.sql import functions as F
    p = plan(S.read_store(spark, root).where(F.col("status") == "raw"))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,raw)]" in p


def test_small_batch_reads_only_its_prefixes(spark, tmp_path):
    root = str(tmp_path / "s")
    S.write_snapshot(spark, root, B.existing_store(spark, SF))
    one = spark.read.schema(S.STORE_SCHEMA).parquet(f"{root}/n=0/kind=base").limit(1).select("uid")
    path = str(tmp_path / "one")
    one.write.parquet(path)
    uids = S.stored_uids(spark, root, spark.read.parquet(path))
    held = spark.read.parquet(path).first().uid[:1]
    p = plan(uids)
    assert f"= {held})" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<uid:string>" in p
    read = {r.f.split("/p=")[1][:1] for r in uids.select(F.input_file_name().alias("f")).collect()}
    assert read == {held} and uids.count() < S.read_rows(spark, root).count()


def test_extraction_is_narrow_and_drops_html(spark):
    """Page extraction adds no hash shuffle; html never reaches a shuffle."""
    from newsflow.operators.extract import extract_articles
    from newsflow.plans.flagship import page_items
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    p = plan(extract_articles(pages))
    assert "hashpartitioning" not in p
    items = page_items(spark, SF)
    p = plan(I.dedup_uid(items, "page_id"))
    exchanges = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("html" not in line for line in exchanges)
    assert "html" not in items.columns


def test_rank_follows_the_order_over_several_files(spark, tmp_path):
    rows = spark.range(500).select(F.xxhash64("id").cast("string").alias("uid"),
                                   F.when(F.col("id") % 9 > 0, F.timestamp_seconds(F.col("id") % 40)).alias("published_dt"))
    path = str(tmp_path / "recent")
    I.recent_first(rows.repartition(5)).write.option("maxRecordsPerFile", 90).parquet(path)
    ranked = I.with_rank(spark.read.parquet(path)).collect()
    want = sorted(rows.collect(), key=lambda r: (r.published_dt is None, -(r.published_dt.timestamp() if r.published_dt else 0), r.uid))
    assert {r.uid: r["rank"] for r in ranked} == {r.uid: n for n, r in enumerate(want, 1)}
    empty = str(tmp_path / "none")
    rows.where("false").write.parquet(empty)
    assert I.with_rank(spark.read.schema(rows.schema).parquet(empty)).count() == 0


def test_union_sources_keeps_other_event_types(spark, monkeypatch):
    from newsflow.plans import queries as Q
    ev = spark.createDataFrame([(1, "view"), (2, "refund"), (3, None), (4, "error")], "event_id long, event_type string").selectExpr(
        "event_id", "timestamp_ntz'2025-01-02 03:04:00' ts", "7L user_id", "event_type", "1.0D value", "'{}' props")
    monkeypatch.setattr(Q.B, "table", lambda *_: ev)
    assert {(r.event_id, r.source) for r in Q.union_sources(spark, "").collect()} == {
        (1, "view"), (2, "refund"), (3, None), (4, "error")}
    assert {r.event_id for r in Q.parse_published(spark, "").collect()} == {1, 2, 3, 4}
