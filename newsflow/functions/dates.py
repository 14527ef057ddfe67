"""Publication-date parsing and formatting.

The collector parses a mixed column with one inferred format, so its result
depends on row order.  Here every row is parsed on its own with an ordered
list of formats (ISO first); anything else is NULL.  Naive times are UTC:
callers run with ``spark.sql.session.timeZone=UTC`` (see ``ensure_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.text import py_strip, _c

# Accepted non-ISO layouts, tried in this order
# ("December 2, 2025 12:20 pm", "Dec 2, 2025", "02-12-2025" day first, RFC 822 without its weekday).
PUBLISHED_FORMATS = ("MMMM d, yyyy h:mm a", "MMM d, yyyy", "dd-MM-yyyy", "MMMM d, yyyy", "MMM d, yyyy h:mm a",
                     "d MMMM yyyy", "d MMM yyyy", "d MMM yyyy HH:mm:ss Z")
# A text without a year would be read as a time of the current day.
YEAR_RE = "[0-9]{4}"
WEEKDAY_RE = "^[A-Za-z]+, +(?=[0-9])"

ISO_OUT = "yyyy-MM-dd'T'HH:mm:ssZ"


def parse_published(c) -> Column:
    """String -> TIMESTAMP (UTC) or NULL; never raises under ANSI."""
    s = py_strip(_c(c))
    s = F.when(s.rlike(YEAR_RE), F.regexp_replace(s, WEEKDAY_RE, ""))
    tries = [F.try_to_timestamp(s)] + [F.try_to_timestamp(s, F.lit(f)) for f in PUBLISHED_FORMATS]
    return F.coalesce(*tries)


def iso_published(ts) -> Column:
    """``strftime('%Y-%m-%dT%H:%M:%S%z')`` of a UTC time, '' for NULL."""
    return F.coalesce(F.date_format(_c(ts), ISO_OUT), F.lit(""))
