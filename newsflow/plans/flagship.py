"""Flagship plan: raw pages -> store rows (minimum end-to-end slice).

pages -> native article extraction -> normalised items (source from the
page host) -> uid -> dedup (newest first) -> store rows, newest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.text import clean_field
from newsflow.functions.urls import make_uid, source_name
from newsflow.operators import extract as EX
from newsflow.operators import items as I
from newsflow.operators import store as S
from newsflow.plans import bindings as B
from newsflow.session import ensure_utc, stage


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_from_pages(B.table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def items_from_pages(pages: DataFrame) -> DataFrame:
    """Collector items from article pages (source = host without 'www.')."""
    a = EX.extract_articles(pages)
    ad = F.col("article_details")
    it = a.select(
        "page_id",
        source_name(F.lit(None).cast("string"), F.col("url")).alias("source"),
        F.col("url").alias("feed_url"),
        clean_field(ad["article_title"]).alias("title"),
        clean_field(ad["short_description"]).alias("summary_raw"),
        clean_field(ad["full_text"]).alias("full_text"),
        clean_field(F.col("url")).alias("link"),
        clean_field(ad["date"]).alias("published"),
        clean_field(ad["article_image_url"]).alias("media_url"),
        F.lit("raw").alias("status"))
    it = it.withColumn("uid", make_uid(F.col("link"), F.col("title")))
    return I.with_published(it)


def collect_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    # staged after extraction: the dedup passes then read narrow columns of
    # files, HTML is parsed once
    items = stage(page_items(spark, sf_dir), "flagship")
    best = I.dedup_uid(items, "page_id")
    rows = S.store_row(best, B.run_ts())
    # ISO text sorts like the time; '' (unparseable) sorts last when descending
    return rows.orderBy(F.col("published_at").desc(), F.col("uid"))
