"""Hot keys stay even without adaptive splitting."""

import statistics

import pytest
from pyspark.sql import functions as F

from newsflow.operators import items as I
from newsflow.operators.skew import hot_keys, lookup


@pytest.fixture()
def plain(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def cards(spark, n=40_000):
    """Half of the rows share one key; one key in a hundred is null."""
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(0, n, 1, 8).select(F.col("id").alias("doc_id"), key.alias("article_url"))


def sizes(df):
    # every column is used, so that no join is optimised away
    each = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max(F.xxhash64(*df.columns)))
    return [r.n for r in each.collect()]


def test_card_lookup_is_even(plain):
    left = cards(plain)
    right = left.where("article_url is not null").groupBy(F.col("article_url").alias("url")).agg(F.struct(F.max("doc_id").alias("m")).alias("article_details"))
    plain_join = I.join_cards_articles(left, right)
    even = I.join_cards_articles(left, right, hot=True)
    assert sorted(map(str, even.collect())) == sorted(map(str, plain_join.collect()))
    assert max(sizes(plain_join)) > 3 * statistics.median(sizes(plain_join))  # what the lookup is there for
    assert max(sizes(even)) <= 2 * statistics.median(sizes(even))


def test_lookup_keeps_every_row(plain):
    left = cards(plain, 3000)
    right = plain.createDataFrame([("hot", 1), ("k1", 2)], "article_url string, v int")
    hot = hot_keys(left, "article_url")
    assert [r.article_url for r in hot.collect()] == ["hot"]
    got = lookup(left, right, "article_url", hot)
    assert got.count() == 3000 and got.where("v = 1").count() == 1500
    assert lookup(left, right, "article_url", hot, "inner").where("v is null").count() == 0
    assert lookup(left.where("false"), right, "article_url", hot_keys(left.where("false"), "article_url")).count() == 0


def test_uid_dedup_of_a_hot_uid_is_even(plain):
    df = cards(plain).select("doc_id", F.coalesce("article_url", F.lit("none")).alias("uid"),
                             F.timestamp_seconds(F.col("doc_id") % 977).alias("published_dt")).withColumn("key", F.struct("doc_id", "uid"))
    want = {}
    for r in df.collect():
        at = (-r.published_dt.timestamp(), r.doc_id)
        want[r.uid] = min(want.get(r.uid, at), at)
    for key in ("doc_id", "key"):  # an integer and a compound tie-break
        out = I.dedup_uid(df, key)
        assert {r.uid: r.doc_id for r in out.collect()} == {u: d for u, (_, d) in want.items()}
    narrow = df.select("uid", F.col("key").alias("_k"), F.col("published_dt").alias("_t"))
    met = lookup(narrow, narrow.groupBy("uid").agg(F.max("_t").alias("n")), "uid", hot_keys(narrow, "uid"), "inner")
    assert max(sizes(met)) <= 2 * statistics.median(sizes(met))
