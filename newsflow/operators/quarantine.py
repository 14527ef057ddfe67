"""What a run could not use, as a table next to its result.

A page that no rule covers and a page whose extraction failed never stop a run;
each leaves one row (page_id, url, site, role, reason, error) here instead of
vanishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_RULE, PARSE = "no site rule", "parse error"
COLUMNS = ["page_id", "url", "site", "role", "reason", "error"]


def unmatched(pages: DataFrame) -> DataFrame:
    """Pages of hosts that no site rule covers (``site`` is null)."""
    return pages.where("site is null").select(
        "page_id", "url", "site", F.lit(None).cast("string").alias("role"), F.lit(NO_RULE).alias("reason"),
        F.concat(F.lit("host "), F.coalesce("host", F.lit(""))).alias("error"))


def failed(extracted: DataFrame, role: str) -> DataFrame:
    """Rows whose extraction ended with a ``parse_error``."""
    return extracted.where("parse_error is not null").select(
        "page_id", "url", "site", F.lit(role).alias("role"), F.lit(PARSE).alias("reason"), F.col("parse_error").alias("error"))


def merge(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*COLUMNS)
