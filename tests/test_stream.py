import os

from conftest import SF
from newsflow.plans import flagship
from newsflow.plans.bindings import run_ts
from newsflow.operators import items as I
from newsflow.operators import store as S
from newsflow.streaming.ingest import ingest_pages


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    root = str(tmp_path)
    ingest_pages(spark, SF, f"{root}/store", f"{root}/ck", flagship.items_from_pages, run_ts(),
                 glob="pages.parquet")
    got = S.read_store(spark, f"{root}/store")
    batch = S.store_row(I.dedup_uid(flagship.page_items(spark, SF), "page_id"), run_ts())
    key = ["uid", "title", "url", "source", "published_at", "status"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))
    n = got.count()
    # same checkpoint: no new batch; fresh checkpoint: everything is skipped
    ingest_pages(spark, SF, f"{root}/store", f"{root}/ck", flagship.items_from_pages, run_ts(),
                 glob="pages.parquet")
    ingest_pages(spark, SF, f"{root}/store", f"{root}/ck2", flagship.items_from_pages, run_ts(),
                 glob="pages.parquet")
    assert S.read_store(spark, f"{root}/store").count() == n
    assert os.path.isdir(f"{root}/ck/commits")


def test_stream_over_split_files_equals_batch(spark, tmp_path):
    """Pages split into several files, one file per micro-batch: the store
    equals the one-batch result; items repeated across batches are skipped."""
    root = str(tmp_path)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    pages.repartition(4, "page_id").write.parquet(f"{root}/pages_in")
    ingest_pages(spark, f"{root}/pages_in", f"{root}/store", f"{root}/ck", flagship.items_from_pages,
                 run_ts(), glob="*.parquet", max_files_per_trigger=1)
    got = S.read_store(spark, f"{root}/store")
    batch = S.store_row(I.dedup_uid(flagship.page_items(spark, SF), "page_id"), run_ts())
    key = ["uid", "title", "url", "source", "published_at", "status"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))
    assert len(os.listdir(f"{root}/ck/commits")) >= 2


def test_site_pages_in_any_order_equal_one_batch(spark, tmp_path):
    """Listings and articles in three files, one a micro-batch, in every order of
    two runs; a restart adds nothing; failures are kept."""
    from newsflow.plans import collect as C
    from newsflow.streaming.ingest import ingest_site_pages
    from test_collect import _pages
    pages = _pages(spark)
    C.collect(spark, pages, f"{tmp_path}/batch", run_ts())
    key = ["uid", "title", "url", "raw_summary", "full_text", "published_at", "source"]
    want = sorted(map(tuple, S.read_store(spark, f"{tmp_path}/batch").select(key).collect()))
    for run, parts in enumerate([[(1, 3, 5), (2,), (4,)], [(4, 2), (5,), (3, 1)]]):
        root = f"{tmp_path}/run{run}"
        for i, ids in enumerate(parts):
            pages.where(pages.page_id.isin(*ids)).coalesce(1).write.mode("append").parquet(f"{root}/in{i}")
            for f in os.listdir(f"{root}/in{i}"):
                if f.endswith(".parquet"):
                    os.makedirs(f"{root}/pages", exist_ok=True)
                    os.rename(f"{root}/in{i}/{f}", f"{root}/pages/{i}.parquet")
                    os.utime(f"{root}/pages/{i}.parquet", (1_000_000 + i, 1_000_000 + i))  # files are taken oldest first
        for _ in range(2):
            ingest_site_pages(spark, f"{root}/pages", f"{root}/store", f"{root}/ck", run_ts(), max_files_per_trigger=1)
            got = sorted(map(tuple, S.read_store(spark, f"{root}/store").select(key).collect()))
            assert got == want
        lost = C.read_quarantine(spark, f"{root}/store")
        assert [(r.page_id, r.reason) for r in lost.collect()] == [(5, "no site rule")]
        assert len(os.listdir(f"{root}/ck/commits")) >= 3


def test_patience_closes_cards_within_the_stream(spark, tmp_path):
    from newsflow.streaming.ingest import ingest_site_pages
    from test_collect import ES, _pages
    pages, root = _pages(spark), str(tmp_path)
    os.makedirs(f"{root}/pages")
    for i, ids in enumerate([(1,), (5,), (2,)]):  # the article comes two micro-batches after its card
        pages.where(pages.page_id.isin(*ids)).coalesce(1).write.parquet(f"{root}/in{i}")
        part = next(f for f in os.listdir(f"{root}/in{i}") if f.endswith(".parquet"))
        os.rename(f"{root}/in{i}/{part}", f"{root}/pages/{i}.parquet")
        os.utime(f"{root}/pages/{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    ingest_site_pages(spark, f"{root}/pages", f"{root}/store", f"{root}/ck", run_ts(), max_files_per_trigger=1, patience=1)
    got = {r.url: r.title for r in S.read_store(spark, f"{root}/store").collect()}
    assert got[ES["base_url"] + "/ent/1"] == "Lead story"  # the listing's title: the article was too late
