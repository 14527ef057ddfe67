"""Joins that stay even when one key holds a large part of the rows.

A key is hot when it holds more than ``SHARE`` of all rows, so there are fewer
than ``1 / SHARE`` hot keys whatever the table's size: the list of them is the
one broadcast with a proven bound.  Rows of a hot key are dealt by a salt, and its
single right row is repeated for every salt; all other keys shuffle as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A hot key holds more than this share of all rows.
SHARE = 1 / 64
#: Parts that the rows of a hot key are dealt to.
SALTS = 64


def hot_keys(df: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """(key): the non-null keys that hold more than ``share`` of the rows of ``df``;
    fewer than ``1 / share`` rows.  Counts are partial aggregates; the rows of a
    staged ``df`` are counted from its files' footers."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    return counts.where(F.col("_rows") > F.lit(share * df.count())).select(key)


def lookup(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, how: str = "left") -> DataFrame:
    """``left`` joined (left or inner) with ``right``, which has one row per key.

    The salt is a hash of the left row, so a repeated task deals its rows alike.
    """
    is_hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    rest = [F.col(f"`{c}`") for c in left.columns if c != key]
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*rest), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(is_hot, key, "left").withColumn("_salt", salt).drop("_hot")
    held = right.join(is_hot, key, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return dealt.join(held, [key, "_salt"], how).drop("_salt")
