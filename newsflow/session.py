"""Session helpers: one place for the configs the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "newsflow",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster the master, memory and shuffle sizing come from spark-submit;
    only the semantic settings (UTC, ANSI-safe functions, AQE) are forced here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", os.environ.get("NEWSFLOW_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Naive times are UTC (the reference parses with ``utc=True``)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and store snapshots.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a
    private scratch folder serves a local master (tests); on a cluster a local
    folder would not be shared, so it is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="newsflow-ckpt-")
        spark.sparkContext.setCheckpointDir(d)  # found again by the next call
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


_FOLDER: ContextVar[str | None] = ContextVar("newsflow-stage-folder", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Tables staged inside go with the block: for runs whose result does not read them."""
    root = checkpoint_root(spark)
    held = _FOLDER.set(f"{root}/run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_FOLDER.get())
        _FOLDER.reset(held)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Removes the shuffle files of a query as it ends, not when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark):
    """Writes inside leave no shuffle files: each plans its own, which nothing reads again."""
    held = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, held)


def stage(df, tag: str):
    """Write ``df`` once as Parquet in the shared folder and read it back: what
    follows reads narrow columns of files, and a lost executor repeats no more."""
    spark = df.sparkSession
    path = f"{_FOLDER.get() or checkpoint_root(spark)}/{tag}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    root, hadoop = checkpoint_root(spark), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = hadoop(folder)
        if path.toUri().getPath().startswith(hadoop(root).toUri().getPath() + "/"):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def observed(observation, name: str) -> int:
    """A count that a finished write observed.  The planner drops a pass over rows
    that it finds to be none, and the observation with it: that count is 0."""
    try:
        return observation.get[name]
    except Py4JJavaError:
        return 0


def spread(df):
    """``df`` dealt to ``spark.newsflow.pagePartitions`` partitions before CPU-heavy
    per-row work, where that is set; otherwise the scan's own splits are kept.

    For inputs of few row groups (a single small file); nothing is probed, so no
    job runs while a plan is built.
    """
    n = df.sparkSession.conf.get("spark.newsflow.pagePartitions", None)
    return df.repartition(int(n)) if n and not df.isStreaming else df


#: Most bytes of one Arrow batch sent to a Python worker (long texts make short batches).
BATCH_BYTES = 8 << 20


def bound_batches(spark) -> None:
    """Bound the Arrow batches of the session in bytes, not in rows alone, so that a
    worker's memory does not follow the length of the texts or the size of its split."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_SHIPPED: set = set()


def ship_package(spark) -> None:
    """Make ``newsflow`` importable in Python workers (``mapInPandas``).

    Workers do not inherit the driver's ``sys.path``; the package is zipped
    once per driver process and added with ``addPyFile`` (the mechanism
    ``spark-submit --py-files`` uses), unless this context already has it.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    d = tempfile.mkdtemp(prefix="newsflow-pyfiles-")
    path = os.path.join(d, "newsflow.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(key)
