"""newsflow: a PySpark news-page ETL.

pages -> listing cards / article details -> joined, normalised, uid-keyed,
deduplicated items -> insert-if-absent store -> enrichment with per-row
fallback -> status transitions -> JSON / parquet outputs.

Everything is a ``DataFrame -> DataFrame`` function or a ``Column`` builder;
Python workers run only for rule-based HTML extraction and model calls.
"""

from newsflow.session import get_spark, ensure_utc, checkpoint_root

__all__ = ["get_spark", "ensure_utc", "checkpoint_root"]
