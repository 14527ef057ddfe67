"""End-to-end batch runs (what the collector and the processor do).

``collect``: pages of the known sites -> listing cards and article details
(rule path) -> card/article left join -> per-site normalisation -> dates ->
uid dedup -> insert-if-absent into the store.  Pages of other hosts and pages
that could not be extracted go to the quarantine table beside the store;
:mod:`newsflow.plans.flagship` reads any host by the native rules.

``process``: store rows still 'raw' -> enrichment -> a commit of patch rows.

Counts come from the passes that write (``observe``), not from jobs of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.urls import url_host, url_path
from newsflow.operators import enrich as E
from newsflow.operators import items as I
from newsflow.operators import quarantine as Q
from newsflow.operators import rules as R
from newsflow.operators import store as S
from newsflow.session import ensure_utc, observed, release, scratch, shuffles_freed, stage
from newsflow.sinks.json_sink import write_items_json


def assign_sites(pages: DataFrame) -> DataFrame:
    """Pages with their host, site and role (J4); no page vanishes.

    The site is that of the longest suffix of the host's labels in the rule
    table (``www.`` and subdomains belong to their site), NULL for a foreign
    host.  The rule table is a constant, so this is one expression per page and
    no join.  ``role`` is 'listing' for the site's listing path, else 'article'.
    """
    hosts = {R.rule_host(r["base_url"]): site for site, r in R.SITES.items()}
    listing = F.create_map(*(F.lit(x) for site, r in R.SITES.items() for x in (site, R.path_of(r["listing_url"]))))
    p = pages.select("page_id", "url", "html", url_host("url").alias("host"))
    p = p.withColumn("site", R.longest_suffix(F.col("host"), hosts))
    same = F.rtrim(url_path("url"), F.lit("/")) == F.try_element_at(listing, F.col("site"))
    return p.withColumn("role", F.when(F.col("site").isNotNull(), F.when(same, "listing").otherwise("article")))


def site_parts(spark: SparkSession, pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cards, articles, quarantine) of some pages, all staged: the pages are read when
    this returns.  Extraction runs once; its raw results are staged, so the failures are
    a second output and not a second run.  Articles have a unique ``row`` number.

    Pages are dealt evenly first: listings lie together in few files, and a
    micro-batch is one file, so the splits of a scan would leave most cores idle."""
    assigned = assign_sites(pages)
    raw, arts = (assigned.where(F.col("role") == role).repartition("page_id", "url") for role in ("listing", "article"))
    raw = stage(R.raw_site_cards(raw), "raw-cards")
    arts = stage(R.extract_site_articles(arts).withColumn("row", F.monotonically_increasing_id()), "site-articles")
    lost = stage(Q.merge(Q.unmatched(assigned), Q.failed(raw, "listing"), Q.failed(arts, "article")), "lost")
    # a failed article page keeps the card with NULL details (left join)
    found = arts.where("parse_error is null").select("page_id", "url", "article_details", "row")
    cards = stage(R.finish_cards(raw), "cards")
    release(raw)
    return cards, found, lost


def subheadline() -> Column:
    """What stands in for a missing summary: the listing's, for the site that has one."""
    return F.when(F.col("site") == "eisamay", F.col("listing_subheadline"))


def joined_items(spark: SparkSession, joined: DataFrame) -> DataFrame:
    """Cards with ``article_details`` (NULL where there are none) -> normalised, dated items."""
    rules = R.site_rules_frame(spark)
    joined = joined.join(F.broadcast(rules.select("site", "source", "feed_url")), "site")
    items = I.normalize_items(joined, F.col("source"), F.col("feed_url"), subheadline())
    # row key in listing order (the reference's ties are unspecified)
    return I.with_published(items.withColumn("row_key", F.struct("page_id", "card_pos")))


def site_items(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Normalised items of the known sites (before dedup)."""
    cards, arts, _ = site_parts(spark, pages)
    return joined_items(spark, I.join_cards_articles(cards, I.unique_articles(arts)))


def insert(spark: SparkSession, store_root: str, items: DataFrame, run_ts=None, key: str = "row_key",
           whole: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Staged items into the store if absent; the number added, counted as they are written.

    Which rows are new is found on uid and key alone: the wide rows move once to be
    picked and once to lie by prefix.  ``whole`` completes the new rows (staged) where
    ``items`` lack their long fields."""
    won = stage(items.select("uid", key).join(I.uid_winners(items, key), key, "left_semi"), "won")
    new = won.join(S.stored_uids(spark, store_root, won), "uid", "left_anti").select(F.col("uid").alias("_uid"), F.col(key).alias("_key"))
    new = items.join(new, (F.col(key) == F.col("_key")) & F.col("uid").eqNullSafe(F.col("_uid")), "left_semi")
    if whole is not None:
        new = whole(stage(new, "new"))
    new = S.store_row(new, run_ts)
    added = Observation()
    S.append_store(spark, store_root, new.observe(added, F.count(F.lit(1)).alias("n")))
    return observed(added, "n")


def collect(spark: SparkSession, pages: DataFrame, store_root: str, run_ts=None,
            json_path: str | None = None, pages_read: Callable[[], None] | None = None) -> DataFrame:
    """Run the collector once; returns the one-row (added, skipped, quarantined) report.

    ``pages_read`` is called when the run needs ``pages`` no more (to delete staged ones)."""
    ensure_utc(spark)
    with scratch(spark):
        return _collect(spark, pages, store_root, run_ts, json_path, pages_read)


def _collect(spark, pages, store_root, run_ts, json_path, pages_read) -> DataFrame:
    cards, arts, lost = site_parts(spark, pages)
    if pages_read is not None:
        pages_read()
    # Dedup and insert work on items without their long texts, which the new ones alone get.
    light = I.unique_articles(I.without_long_fields(arts))
    items = joined_items(spark, I.join_cards_articles(cards, light, hot=True))
    # Staged in the shared folder: dedup reads files instead of repeating the join.
    seen, dropped = Observation(), Observation()
    items = stage(items.observe(seen, F.count(F.lit(1)).alias("n")), "items")
    release(cards)
    (lost.observe(dropped, F.count(F.lit(1)).alias("n"))
     .write.parquet(f"{store_root}/_quarantine/run={uuid.uuid4().hex}"))
    if json_path:
        every = stage(I.join_long_fields(items, arts, "row_key", subheadline()), "whole")
        with shuffles_freed(spark):
            write_items_json(I.recent_first(every).drop("published_dt", "row_key"), json_path)
        release(every)

    def whole(new: DataFrame) -> DataFrame:
        rows = stage(I.join_long_fields(new, arts, "row_key", subheadline()).drop("article_details"), "whole")
        for read in (arts, items, new):  # before the rows move again and are written
            release(read)
        return rows

    added = insert(spark, store_root, items, run_ts, whole=whole)
    return spark.createDataFrame([(added, observed(seen, "n") - added, observed(dropped, "n"))], "added long, skipped long, quarantined long")


def read_quarantine(spark: SparkSession, store_root: str) -> DataFrame:
    """All quarantined pages of a store's runs."""
    return spark.read.parquet(f"{store_root}/_quarantine").select(*Q.COLUMNS, "run")


def process(spark: SparkSession, store_root: str, generate, run_ts=None, partitions: int | None = None,
            max_row_bytes: int = E.STORE_ROW_BYTES) -> DataFrame:
    """Run the processor once over every 'raw' row; returns the one-row report
    (commit, ready, error).

    Answers are kept beside the store under (uid, kind, prompt) as they are
    made, so a run that died asks only what is missing; the patch is then one
    commit of patch rows, whatever the size of the store.
    """
    ensure_utc(spark)
    with scratch(spark):
        return _process(spark, store_root, generate, run_ts, partitions, max_row_bytes)


def _process(spark, store_root, generate, run_ts, partitions, max_row_bytes) -> DataFrame:
    raw = S.read_raw(spark, store_root)
    patch = E.enrich(raw, generate, run_ts=run_ts, partitions=partitions, max_row_bytes=max_row_bytes,
                     answers=f"{store_root}/_answers", run=uuid.uuid4().hex)
    done = Observation()
    patch = patch.observe(done, *(F.count_if(F.col("status") == s).alias(s) for s in ("ready", "error")))
    n = S.append_patch(spark, store_root, patch)
    return spark.createDataFrame([(n, observed(done, "ready"), observed(done, "error"))], "commit int, ready long, error long")
