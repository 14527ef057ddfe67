"""Bind the operators to the given tables.

The driver tables stand in for the reference's inputs:
* ``pages``      -> listing and article pages;
* ``documents``  -> items: title = first line, summary = second line,
                    link = the source's home URL, full text = the text;
* ``events``     -> publication dates (one event per document id, rendered
                    in the layouts the sites use, or unparseable);
* ``labels``     -> the already-stored items (existing store) and the
                    article side of the card/article join.
Everything here is derived by Spark from those tables, so the work grows
with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.text import first_line, line_at, py_strip
from newsflow.operators import items as I
from newsflow.operators import store as S
from newsflow.operators.enrich import TEXT_FIELDS
from newsflow.session import stage

# Fixed run timestamp so outputs are reproducible (the reference uses now()).
RUN_TS = "2025-01-01 00:00:00"


#: Row limit of the store in the queries, small enough for the given documents to reach it.
ROW_LIMIT = 16_384


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def render_published(ts: Column, kind: Column) -> Column:
    """Publication text per event type: two ISO layouts, the long English
    one with lower-case am/pm, the short English one, or unparseable."""
    return (F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(kind == "signup", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                                              F.lit("+05:30")))
            .when(kind == "click", F.concat(F.date_format(ts, "MMMM d, yyyy h:mm "),
                                             F.lower(F.date_format(ts, "a"))))
            .when(kind == "purchase", F.date_format(ts, "MMM d, yyyy"))
            .otherwise(F.lit("")))


def doc_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("doc_id"),
                     render_published(F.col("ts"), F.col("event_type")).alias("published_src"))


def doc_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collector items (before dedup), one per document, with dates."""
    # cut before the join: who needs no full text moves none
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", py_strip(first_line("text")).alias("title"),
        py_strip(F.coalesce(line_at("text", 1), F.lit(""))).alias("summary_raw"), py_strip("text").alias("full_text"))
    d = docs.join(doc_published(spark, sf_dir), "doc_id", "left")
    link = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/"))
    out = d.select(
        "doc_id",
        F.col("source"),
        F.concat(link, F.lit("feed")).alias("feed_url"),
        "title",
        "summary_raw",
        "full_text",
        link.alias("link"),
        py_strip(F.coalesce("published_src", F.lit(""))).alias("published"),
        F.lit("").alias("media_url"),
        F.lit("raw").alias("status"))
    out = out.withColumn("uid", I.make_uid(F.col("link"), F.col("title")))
    return I.with_published(out)


def existing_store(spark: SparkSession, sf_dir: str, items: DataFrame | None = None) -> DataFrame:
    """Store rows already present: items of labelled documents (``items`` when
    they are staged already); status by label (quality 1 -> raw, else toxic 1
    -> ready, else error)."""
    it = (doc_items(spark, sf_dir) if items is None else items).join(table(spark, sf_dir, "labels"), "doc_id")
    best = I.dedup_uid(it, "doc_id")
    status = (F.when(F.col("quality") == 1, "raw").when(F.col("toxic") == 1, "ready")
              .otherwise("error"))
    return S.store_row(best, run_ts(), status)


def raw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store in which every item of ``documents`` is still to be processed."""
    return S.store_row(I.dedup_uid(doc_items(spark, sf_dir), "doc_id"), run_ts())


def landed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those rows as they land: one JSON document each.  Documents labelled toxic
    land with a number where the title should be."""
    best = stage(I.dedup_uid(doc_items(spark, sf_dir), "doc_id"), "best")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    odd = best.join(toxic, "doc_id", "left_semi").select("uid", F.lit(True).alias("odd"))
    rows = S.store_row(best, run_ts()).select("uid", *TEXT_FIELDS).join(odd, "uid", "left")
    rest = [F.col(f) for f in TEXT_FIELDS if f != "title"]
    whole, number = (F.to_json(F.struct(t, *rest)) for t in (F.col("title"), F.length("title").alias("title")))
    return rows.select("uid", F.when(F.col("odd"), number).otherwise(whole).alias("document"))


def doc_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing cards, one per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select(
        "doc_id",
        first_line("text").alias("title"),
        F.concat(F.lit("https://news.example.org/doc/"), F.col("doc_id")).alias("article_url"),
        F.concat(F.lit("https://img.example.org/card/"), F.col("doc_id"), F.lit(".jpg"))
        .alias("card_image_url"),
        line_at("text", 1).alias("listing_subheadline"))


def doc_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article details for labelled documents, keyed by URL."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels")
    d = docs.join(lab, "doc_id").join(doc_published(spark, sf_dir), "doc_id", "left")
    q = F.col("quality") == 1
    details = F.struct(
        F.when(q, first_line("text")).otherwise(F.lit("")).alias("article_title"),
        F.when(q, line_at("text", 1)).alias("short_description"),
        F.when(F.col("toxic") == 0, F.concat(F.lit("https://img.example.org/art/"),
                                             F.col("doc_id"), F.lit(".jpg")))
        .otherwise(F.lit("")).alias("article_image_url"),
        F.lit(None).cast("string").alias("author"),
        F.col("published_src").alias("date"),
        F.col("text").alias("full_text"))
    return d.select(F.col("doc_id").alias("page_id"),
                    F.concat(F.lit("https://news.example.org/doc/"), F.col("doc_id")).alias("url"),
                    details.alias("article_details"))
