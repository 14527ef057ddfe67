"""Keyed item store on parquet: insert-if-absent, partial update, stats.

Layout: ``<root>/n=<number>/kind=<add|patch|base>/p=<uid prefix>/``.  The store is
a log of numbered commits, never rewritten in place: an insert adds rows, a partial
update adds patch rows, and :func:`compact` rewrites only the uid prefixes it is
given (or those that have patches) as their new base.  A reader takes, per prefix,
the newest base with the rows and patches after it; of several patches of a uid the
newest value of each field counts.  A commit counts once its ``_SUCCESS`` marker is
written, so a writer that died leaves nothing that is read.  Single writer by
contract.  Uids are digests, so the prefixes are even, and a small batch reads only
the prefixes it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.text import truthy_or
from newsflow.session import shuffles_freed

STORE_SCHEMA = T.StructType([
    T.StructField("uid", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("raw_summary", T.StringType()),
    T.StructField("full_text", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("feed_url", T.StringType()),
    T.StructField("media_url", T.StringType()),
    T.StructField("published_raw", T.StringType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("summary", T.StringType()),
    T.StructField("caption_telegram", T.StringType()),
    T.StructField("caption_instagram", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("ai_mode", T.StringType()),
    T.StructField("gemini_error", T.StringType()),
    T.StructField("processing_error", T.StringType()),
])
PATCH_FIELDS = ["summary", "caption_telegram", "caption_instagram", "status", "processed_at",
                "ai_mode", "gemini_error", "processing_error"]


def store_row(items: DataFrame, run_ts: Column | None = None,
              status: Column | None = None) -> DataFrame:
    """Collector item -> store row (renames, defaults, status 'raw')."""
    ts = run_ts if run_ts is not None else F.current_timestamp()
    cols = {
        "uid": F.col("uid"),
        "title": F.col("title"),
        "raw_summary": F.col("summary_raw"),
        "full_text": F.coalesce(F.col("full_text"), F.lit("")),
        "url": F.col("link"),
        "source": F.col("source"),
        "feed_url": F.col("feed_url"),
        "media_url": truthy_or(F.col("media_url")),
        "published_raw": F.col("published"),
        "published_at": F.coalesce(F.col("published_dt_str"), F.lit("")),
        "status": status if status is not None else F.lit("raw"),
        "created_at": ts.cast("timestamp"),
    }
    out = items.select(*[v.alias(k) for k, v in cols.items()])
    for f in STORE_SCHEMA.fields[len(cols):]:
        out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out


def existing_uids(batch: DataFrame, store: DataFrame) -> DataFrame:
    """uids of the store that the batch holds too.

    No hint and no count: over a batch staged as files the planner knows the
    size of its ``uid`` column, broadcasts it when small (the store is then
    only scanned) and otherwise shuffles uids alone.
    """
    return store.select("uid").join(batch.select("uid"), "uid", "left_semi")


def insert_new(batch: DataFrame, store: DataFrame) -> DataFrame:
    """Rows of a uid-unique batch whose uid is absent from the store."""
    return batch.join(existing_uids(batch, store), "uid", "left_anti")


def insert_skipped(batch: DataFrame, store: DataFrame) -> DataFrame:
    """Rows of the batch whose uid is already stored (left semi)."""
    return batch.join(existing_uids(batch, store), "uid", "left_semi")


def insert_stats(batch_all: DataFrame, added: DataFrame) -> DataFrame:
    """One row (added, skipped); skipped counts in-batch repeats too."""
    flags = (batch_all.select(F.lit(0).alias("a"), F.lit(1).alias("n"))
             .unionByName(added.select(F.lit(1).alias("a"), F.lit(0).alias("n"))))
    return flags.agg(F.sum("a").cast("long").alias("added"),
                     (F.sum("n") - F.sum("a")).cast("long").alias("skipped"))


def apply_patch(store: DataFrame, patch: DataFrame) -> DataFrame:
    """Partial update by uid: a non-NULL patch field overwrites, every other
    field is kept; a patch for an unknown uid inserts nothing.

    The patch is not counted here (that would repeat the model calls of a
    lazily computed one): written patch files have a size the planner knows,
    otherwise AQE picks the join from the runtime size.
    """
    p = patch.select("uid", *[F.col(c).alias("_p_" + c) for c in PATCH_FIELDS if c in patch.columns])
    j = store.join(p, "uid", "left")
    cols = []
    for f in STORE_SCHEMA.fieldNames():
        if f in PATCH_FIELDS and "_p_" + f in p.columns:
            cols.append(F.coalesce(F.col("_p_" + f), F.col(f)).alias(f))
        else:
            cols.append(F.col(f))
    return j.select(*cols)


# ---------------------------------------------------------------------------
# snapshot I/O
# ---------------------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def commits(spark: SparkSession, root: str) -> list[tuple[int, str, list[str]]]:
    """(number, kind, prefixes) of every complete commit, in order (directory names only);
    an empty one has kind ''."""
    fs, p, jvm = _fs(spark, root)
    path = jvm.org.apache.hadoop.fs.Path

    def named(folder, key: str) -> list[tuple[str, object]]:
        found = [(st.getPath().getName(), st.getPath()) for st in fs.listStatus(folder)]
        return [(name[len(key):], at) for name, at in found if name.startswith(key)]

    out = []
    for number, at in named(p, "n=") if fs.exists(p) else ():
        if fs.exists(path(at, "_SUCCESS")):
            out += [(int(number), kind, [x for x, _ in named(inner, "p=")]) for kind, inner in named(at, "kind=")] or [(int(number), "", [])]
    return sorted(out)


def last_number(spark: SparkSession, root: str, key: str) -> int | None:
    """The largest number of the complete folders ``<root>/<key><number>``."""
    fs, p, jvm = _fs(spark, root)
    found = [st.getPath() for st in fs.listStatus(p)] if fs.exists(p) else []
    numbers = [int(at.getName()[len(key):]) for at in found
               if at.getName().startswith(key) and fs.exists(jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS"))]
    return max(numbers, default=None)


def prefix_chars(spark: SparkSession) -> int:
    """Characters of a uid that name its partition (``spark.newsflow.storePrefix``: one
    setting for the life of a store, such that a prefix holds about a gigabyte; 1 to 4)."""
    return int(spark.conf.get("spark.newsflow.storePrefix", "1"))


def prefix(spark: SparkSession) -> Column:
    return F.substring("uid", 1, prefix_chars(spark))


def _commit(spark: SparkSession, root: str, rows: DataFrame, kind: str) -> int:
    """Write the next commit; rows lie by prefix and, inside, by status, so that a
    status filter skips row groups.  Rebalancing splits large prefixes and joins small ones."""
    numbers = [n for n, _, _ in commits(spark, root)]
    n = max(numbers) + 1 if numbers else 0
    placed = rows.withColumns({"kind": F.lit(kind), "p": prefix(spark)}).hint("rebalance", "p").sortWithinPartitions("kind", "p", "status")
    with shuffles_freed(rows.sparkSession):
        placed.write.mode("overwrite").partitionBy("kind", "p").parquet(f"{root}/n={n}")  # n holds an aborted write at most
    return n


def _read(spark: SparkSession, root: str, kinds: tuple[str, ...], prefixes: list[str] | None) -> DataFrame | None:
    """Rows of the commits of some kinds that count, with their number ``n``; None where there are none.

    Which commits count is a predicate on directory names alone."""
    log = commits(spark, root)
    base = {p: n for n, kind, held in log if kind == "base" for p in held}  # the newest one last
    wanted = [(n, kind, p) for n, kind, held in log if kind in kinds for p in held
              if n >= base.get(p, 0) and (prefixes is None or p in prefixes)]
    if not wanted:
        return None
    schema = T.StructType([*STORE_SCHEMA.fields, T.StructField("n", T.IntegerType()), T.StructField("kind", T.StringType()),
                           T.StructField("p", T.StringType())])
    paths = sorted({f"{root}/n={n}/kind={kind}" for n, kind, _ in wanted})
    rows = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    if prefixes is not None:
        rows = rows.where(F.col("p").isin(sorted(prefixes)))
    for number in sorted(set(base.values())):  # older rows of a prefix that has a newer base
        rows = rows.where((F.col("n") >= number) | ~F.col("p").isin(sorted(p for p, n in base.items() if n == number)))
    return rows


def read_rows(spark: SparkSession, root: str, prefixes: list[str] | None = None) -> DataFrame:
    """Stored rows as inserted or compacted, before later patches."""
    rows = _read(spark, root, ("add", "base"), prefixes)
    return rows.select(*STORE_SCHEMA.fieldNames()) if rows is not None else spark.createDataFrame([], STORE_SCHEMA)


def read_patches(spark: SparkSession, root: str, prefixes: list[str] | None = None) -> DataFrame | None:
    """One row per patched uid: the newest value that any later patch gives each field."""
    rows = _read(spark, root, ("patch",), prefixes)
    if rows is None:
        return None
    newest = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col("n"))).alias(f) for f in PATCH_FIELDS]
    return rows.groupBy("uid").agg(*newest)


def read_store(spark: SparkSession, root: str, prefixes: list[str] | None = None) -> DataFrame:
    """The store as it stands (or only some uid prefixes of it)."""
    patches = read_patches(spark, root, prefixes)
    rows = read_rows(spark, root, prefixes)
    return rows if patches is None else apply_patch(rows, patches)


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """Rows still 'raw': the status filter reaches the files, and of the patches only uids are read."""
    raw = read_rows(spark, root).where(F.col("status") == "raw")
    patches = _read(spark, root, ("patch",), None)
    return raw if patches is None else raw.join(patches.where("status is not null and status <> 'raw'").select("uid"), "uid", "left_anti")


def stored_uids(spark: SparkSession, root: str, batch: DataFrame) -> DataFrame:
    """uids of the store in the partitions that ``batch`` (staged) holds.

    The prefixes are at most 16 ** ``spark.newsflow.storePrefix`` short strings."""
    held = [r.p for r in batch.select(prefix(spark).alias("p")).distinct().collect() if r.p is not None]
    return read_rows(spark, root, held).select("uid")


def append_store(spark: SparkSession, root: str, rows: DataFrame) -> int:
    return _commit(spark, root, rows.select(*STORE_SCHEMA.fieldNames()), "add")


def append_patch(spark: SparkSession, root: str, patch: DataFrame) -> int:
    """Partial update of some uids: their patch rows and nothing else are written."""
    missing = [F.lit(None).cast(STORE_SCHEMA[f].dataType).alias(f) for f in PATCH_FIELDS if f not in patch.columns]
    return _commit(spark, root, patch.select("uid", *(f for f in PATCH_FIELDS if f in patch.columns), *missing), "patch")


def write_snapshot(spark: SparkSession, root: str, df: DataFrame) -> int:
    """A new base of all prefixes that ``df`` holds."""
    return _commit(spark, root, df.select(*STORE_SCHEMA.fieldNames()), "base")


def compact(spark: SparkSession, root: str, prefixes: list[str] | None = None) -> list[str]:
    """Rewrite the prefixes that have patches (or the given ones) with the patches
    applied; the others are not read.  Returns the prefixes rewritten."""
    base: dict[str, int] = {}
    patched: set[str] = set()
    for n, kind, held in commits(spark, root):
        if kind == "base":
            base.update(dict.fromkeys(held, n))
            patched -= set(held)
        elif kind == "patch":
            patched |= set(held)
    chosen = sorted(patched if prefixes is None else prefixes)
    if chosen:
        write_snapshot(spark, root, read_store(spark, root, chosen))
    return chosen
