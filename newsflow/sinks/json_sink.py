"""JSON export of items (every key written, NULLs kept, UTF-8 text)."""

from __future__ import annotations

from pyspark.sql import DataFrame


#: Most items of one part file.
FILE_ROWS = 50_000


def write_items_json(items: DataFrame, path: str) -> None:
    """Overwrite ``path`` with JSON lines, one object per item.

    The writer keeps NULL fields (``ignoreNullFields=false``) so every key
    is present, and writes non-ASCII text as is.  Output is a directory of
    part files (one per task) instead of one array, so the export scales
    with the data; ordering inside parts follows the input plan.
    """
    (items.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
     .option("ignoreNullFields", "false")
     .option("encoding", "UTF-8")
     .json(path))
