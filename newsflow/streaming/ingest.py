"""Incremental runs with Structured Streaming.

T1 ``ingest_pages``: file source of pages -> native extraction -> items ->
``foreachBatch`` (uid dedup + insert-if-absent + append).  The store is the
dedup state (horizon: forever), so no watermark and no streaming state are
kept; replaying a micro-batch is harmless because the anti join skips uids
the first attempt already wrote.  A micro-batch reads only the uid prefixes it holds.

T1 with site rules, ``ingest_site_pages``: listings and articles arrive in any
order.  Cards wait in a table for the article of their URL; what still waits at
the end (or longer than ``patience`` micro-batches) goes in without one, as the
batch collector does with a card whose article it cannot get.

T2 ``process_raw``: file source over the store's files -> rows still 'raw'
-> enrichment -> patch rows in ``<root>/patches/epoch=<n>``.  The current
store is ``apply_patch(store, latest patch per uid)``.

All run with ``trigger(availableNow=True)`` and a checkpoint in the shared
folder, so a restarted run resumes where the last one committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators import enrich as E
from newsflow.operators import items as I
from newsflow.operators import rules as R
from newsflow.operators import store as S
from newsflow.plans import collect as C
from newsflow.session import scratch, stage

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


def ingest_pages(spark: SparkSession, pages_dir: str, store_root: str, checkpoint: str,
                 to_items, run_ts=None, glob: str = "pages*.parquet",
                 max_files_per_trigger: int | None = None) -> None:
    """Run T1 until the available page files are consumed.

    ``to_items(pages_df) -> items_df`` turns a micro-batch of pages into
    collector items (uid, published_dt, ...); ``store_root`` holds the
    snapshot-layout store of :mod:`newsflow.operators.store`.
    """
    reader = spark.readStream.schema(PAGES_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(pages_dir)

    def batch(df: DataFrame, epoch_id: int) -> None:
        # the micro-batch's items are staged, so extraction runs once
        with scratch(spark):
            C.insert(spark, store_root, stage(to_items(df), "items"), run_ts, "page_id")

    q = (src.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_site_pages(spark: SparkSession, pages_dir: str, store_root: str, checkpoint: str, run_ts=None,
                      glob: str = "*.parquet", max_files_per_trigger: int | None = None, patience: int | None = None) -> None:
    """Run T1 with the site rules until the available page files are consumed.

    Tables beside the store, one folder per micro-batch and rewritten whole by a
    replay: the articles seen, the cards that wait, the quarantine.  Per
    micro-batch, waiting cards meet the new articles and new cards meet all
    articles.  Of several pages of one URL the first micro-batch counts, then the
    smallest page id.
    """
    reader = spark.readStream.schema(PAGES_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    waiting, articles = f"{store_root}/_waiting", f"{store_root}/_articles"

    def items_into_store(joined: DataFrame) -> None:
        C.insert(spark, store_root, stage(C.joined_items(spark, joined), "items"), run_ts)

    def left_without(cards: DataFrame) -> DataFrame:
        return cards.withColumn("article_details", F.lit(None).cast(R.DETAILS_TYPE)).drop("since")

    def batch(df: DataFrame, epoch_id: int) -> None:
        with scratch(spark):
            meet(df, epoch_id)

    def meet(df: DataFrame, epoch_id: int) -> None:
        cards, arts, lost = C.site_parts(spark, df)
        cards = cards.withColumn("since", F.lit(epoch_id).cast("long"))
        lost.write.mode("overwrite").parquet(f"{store_root}/_quarantine/run=epoch-{epoch_id}")
        arts.drop("row").write.mode("overwrite").parquet(f"{articles}/epoch={epoch_id}")
        new = spark.read.parquet(f"{articles}/epoch={epoch_id}")
        seen = spark.read.parquet(articles).where(F.col("epoch") <= epoch_id).withColumn("order", F.struct("epoch", "page_id"))
        joined = I.join_cards_articles(cards, I.unique_articles(seen, order="order"), hot=True)
        if epoch_id > 0:
            before = spark.read.parquet(f"{waiting}/epoch={epoch_id - 1}")
            joined = joined.unionByName(I.join_cards_articles(before, I.unique_articles(new), hot=True))
        joined = stage(joined, "met")
        late = F.lit(False) if patience is None else F.col("since") <= epoch_id - patience
        met = F.col("article_details").isNotNull()
        (joined.where(~met & ~late).drop("article_details")
         .write.mode("overwrite").parquet(f"{waiting}/epoch={epoch_id}"))
        items_into_store(joined.where(met | late).drop("since"))

    q = (reader.parquet(pages_dir).writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    last = S.last_number(spark, waiting, "epoch=")
    if last is not None:  # the available files are read: whoever still waits goes in alone
        with scratch(spark):
            rest = stage(spark.read.parquet(f"{waiting}/epoch={last}"), "closing")
            items_into_store(left_without(rest))
            rest.where("false").write.mode("overwrite").parquet(f"{waiting}/epoch={last}")


def process_raw(spark: SparkSession, store_files: str, patch_dir: str, checkpoint: str,
                generate, run_ts=None, max_row_bytes: int = E.STORE_ROW_BYTES) -> None:
    """Run T2 over the store's parquet files until they are consumed."""
    src = spark.readStream.schema(S.STORE_SCHEMA).parquet(store_files)

    def batch(df: DataFrame, epoch_id: int) -> None:
        raw = df.where(F.col("status") == "raw")
        patch = E.enrich(raw, generate, run_ts=run_ts, max_row_bytes=max_row_bytes)
        # one folder per epoch: a replayed micro-batch replaces its own patches
        patch.write.mode("overwrite").parquet(f"{patch_dir}/epoch={epoch_id}")

    q = (src.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def latest_patches(patches: DataFrame) -> DataFrame:
    """One patch per uid: the one from the latest micro-batch.

    Only (uid, epoch) is aggregated; a micro-batch holds a uid once, so the
    semi join keeps one wide row each.
    """
    last = patches.groupBy("uid").agg(F.max("epoch").alias("epoch"))
    return patches.join(last, ["uid", "epoch"], "left_semi").drop("epoch")
