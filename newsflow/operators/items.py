"""Item operators: card/article join, normalisation, union, dates, dedup,
ordering and top-k.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.dates import iso_published, parse_published
from newsflow.functions.text import clean_field
from newsflow.functions.urls import make_uid
from newsflow.operators.skew import hot_keys, lookup


def unique_articles(articles: DataFrame, key: str = "url", order: str = "page_id") -> DataFrame:
    """One article per key (the smallest ``order`` wins; (key, order) is
    unique: one page has one URL).

    The winner is found by a hash aggregate on two narrow columns (map-side
    combine: a key holding a third of all rows costs one row per task in
    the shuffle); the details struct is then kept by a semi join, so
    the wide article text is never aggregated.
    """
    win = articles.groupBy(key).agg(F.min(order).alias(order))
    return (articles.join(win, [key, order], "left_semi")
            .select(key, "article_details"))


def join_cards_articles(cards: DataFrame, articles: DataFrame, card_key: str = "article_url",
                        article_key: str = "url", hot: bool = False) -> DataFrame:
    """Card -> article lookup: left outer on the URL; cards without a URL
    are dropped first (``if not url: continue``).  ``article_details`` is
    built before the join, so it is NULL when no article matched.
    ``articles`` must be unique by ``article_key`` (see :func:`unique_articles`).

    ``hot``: measure which URLs hold a large part of the (staged) cards, as the
    base URL of links without a target does, and meet those without a shuffle.
    """
    kept = cards.where(F.coalesce(F.col(card_key), F.lit("")) != "")
    arts = articles.select(F.col(article_key).alias("_akey"), "article_details")
    if hot:
        keyed = kept.withColumn("_akey", F.col(card_key))
        return lookup(keyed, arts, "_akey", hot_keys(keyed, "_akey")).drop("_akey")
    return (kept.join(arts, kept[card_key] == arts["_akey"], "left").drop("_akey"))


def normalize_items(joined: DataFrame, source: Column, feed_url: Column,
                    summary_fallback: Column | None = None) -> DataFrame:
    """Collector normalisation: 10 fields from card + details, card fields
    kept, ``title`` overridden.  ``summary_fallback`` is the listing
    subheadline for the site that has one."""
    ad, long = F.col("article_details"), long_fields(summary_fallback)
    title = clean_field(ad["article_title"], F.col("title"))
    link = clean_field(F.col("article_url"))
    out = joined.withColumns({
        "title": title,
        "link": link,
        "summary_raw": long["summary_raw"],
        "media_url": clean_field(ad["article_image_url"], F.col("card_image_url")),
        "published": clean_field(ad["date"]),
        "full_text": long["full_text"],
    })
    return out.withColumns({
        "uid": make_uid(F.col("link"), F.col("title")),
        "source": source,
        "feed_url": feed_url,
        "status": F.lit("raw"),
    })


def long_fields(summary_fallback: Column | None = None) -> dict[str, Column]:
    """The two fields that hold running text, of ``article_details``."""
    ad = F.col("article_details")
    summary = clean_field(ad["short_description"], summary_fallback) \
        if summary_fallback is not None else clean_field(ad["short_description"])
    return {"summary_raw": summary, "full_text": clean_field(ad["full_text"])}


def without_long_fields(articles: DataFrame, key: str = "row") -> DataFrame:
    """Articles whose details lack the running text and name the article by its unique
    ``key`` instead (a last field), so that joins and dedup move narrow rows."""
    ad = F.col("article_details")
    kept = [F.lit(None).cast("string").alias(f) if f in ("short_description", "full_text") else ad[f].alias(f)
            for f in articles.schema["article_details"].dataType.fieldNames()]
    return articles.withColumn("article_details", F.struct(*kept, F.col(key).alias(key))).drop(key)


def join_long_fields(items: DataFrame, articles: DataFrame, order: str, summary_fallback: Column | None = None,
                     key: str = "row") -> DataFrame:
    """Items made of :func:`without_long_fields` (staged) with their whole details again
    and the fields made of them: each article moves once, to the items that name it.

    Items without an article are dealt by their ``order``, under keys that no article has.
    """
    none = -1 - F.pmod(F.xxhash64(order), F.lit(1 << 40))
    keyed = items.withColumn(key, F.coalesce(F.col("article_details")[key], none)).drop("article_details")
    whole = lookup(keyed, articles.select(key, "article_details"), key, hot_keys(keyed, key))
    return whole.withColumns(long_fields(summary_fallback)).select(*items.columns)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Append per-source frames with different columns (missing -> NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def align_sources(rows: DataFrame, source: str, columns: dict[str, list[str]]) -> DataFrame:
    """The union of several sources that lie in one table, in one scan: each row
    keeps the columns that its source has (``columns``, by the value of ``source``)
    and NULL elsewhere, as :func:`union_sources` of the sources one by one would."""
    optional = sorted({c for names in columns.values() for c in names})
    has = {c: F.coalesce(F.col(source).isin(*(k for k, names in columns.items() if c in names)), F.lit(False)) for c in optional}
    return rows.withColumns({c: F.when(has[c], F.col(c)) for c in optional})


def with_published(items: DataFrame) -> DataFrame:
    """``published_dt`` (TIMESTAMP or NULL) and ``published_dt_str`` ('' for NULL)."""
    return (items.withColumn("published_dt", parse_published(F.col("published")))
            .withColumn("published_dt_str", iso_published(F.col("published_dt"))))


#: A 64-bit key's span, and the place of rows without a time (after every time to the year 9999).
KEYS, LAST = 1 << 64, 10 ** 18


def uid_winners(items: DataFrame, tiebreak: str) -> DataFrame:
    """(``tiebreak``): the key of each uid's first item in newest-first order.

    Newest time first (rows without a time last), then the smallest tie-break
    key, which may be any orderable column (a struct for compound keys) and must
    be unique.  Winners are picked on narrow columns by aggregates that combine
    per task before the shuffle, so a hot uid (every item with empty link and
    title shares ``md5('|')``) never lands whole in one task.

    For an integer key, time and key are one exact decimal (microseconds turned
    round, times 2^64, plus the key), so one aggregate finds the winner.  Other
    keys take two: the newest time of each uid, met by hot uids without a
    shuffle, then the smallest key at that time.
    """
    if isinstance(items.schema[tiebreak].dataType, (T.LongType, T.IntegerType)):
        wide = "decimal(38,0)"
        late = F.coalesce(-F.unix_micros("published_dt"), F.lit(LAST)).cast(wide)
        span, half = (F.lit(Decimal(n)).cast(wide) for n in (KEYS, KEYS // 2))
        place = late * span + (F.col(tiebreak).cast(wide) + half)
        win = items.select("uid", place.cast(wide).alias("_w")).groupBy("uid").agg(F.min("_w").alias("_w"))
        key = F.pmod(F.col("_w"), span) - half
        return win.select(key.cast(items.schema[tiebreak].dataType).alias(tiebreak))
    narrow = items.select("uid", F.col(tiebreak).alias("_k"), F.col("published_dt").alias("_t"))
    newest = narrow.groupBy("uid").agg(F.max("_t").alias("_newest"))
    win = (lookup(narrow, newest, "uid", hot_keys(narrow, "uid"), "inner").where(F.col("_t").eqNullSafe(F.col("_newest")))
           .groupBy("uid").agg(F.min("_k").alias(tiebreak)))
    return win.select(tiebreak)


def dedup_uid(items: DataFrame, tiebreak: str) -> DataFrame:
    """Keep one row per uid: the first in newest-first order (:func:`uid_winners`);
    the wide rows are kept by a semi join on the unique key.  Read ``items`` from staged
    files when it is expensive to compute: it is scanned more than once."""
    return items.join(uid_winners(items, tiebreak), tiebreak, "left_semi")


def recent_first(items: DataFrame) -> DataFrame:
    """Newest first, unparseable last; uid breaks ties (determinism)."""
    return items.orderBy(F.col("published_dt").desc_nulls_last(), F.col("uid").asc())


def with_rank(ordered: DataFrame, part: Column | None = None, row: Column | None = None) -> DataFrame:
    """``ordered`` (globally sorted, staged as files in that order) with ``rank`` from 1.

    No single-task window over the rows: each file counts its own, and only the
    counts, one small row per file, are summed up in order.  ``part`` and ``row``
    name a row's place otherwise: what orders the parts, and numbers without a gap
    inside each, from any start.
    """
    file = F.col("_metadata.file_name")  # a longer name is a later task's number
    at = F.struct((F.struct(F.length(file), file) if part is None else part).alias("part"),
                  (F.col("_metadata.row_index") if row is None else row).alias("row"))
    placed = ordered.select("*", at.alias("_at"))
    counts = placed.groupBy(F.col("_at.part").alias("_part")).agg(F.count("*").alias("_n"), F.min("_at.row").alias("_first"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_before"))
    return (placed.join(before, F.col("_at.part") == F.col("_part"))
            .withColumn("rank", (F.col("_before") + F.col("_at.row") + 1).cast("long"))
            .drop("_at", "_part", "_before"))


def top_headlines(items: DataFrame, k: int = 3) -> DataFrame:
    """The first k items of the newest-first order (TakeOrderedAndProject)."""
    return recent_first(items).limit(k)
