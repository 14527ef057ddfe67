"""Table readers: only the needed columns reach the scan (pruned by the
parquet reader), filters stay plain column = literal so they are pushed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsflow.operators.store import read_raw


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw pages (page_id, url, html) -- listing and article sources."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_raw_items(spark: SparkSession, store_root: str) -> DataFrame:
    """Store rows still waiting for enrichment (status = 'raw')."""
    return read_raw(spark, store_root)
