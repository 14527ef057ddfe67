"""Helpers shared by the corpus operators.

Staged tables go to the folder the cluster names in ``spark.checkpoint.dir``
(see ``newsflow.session.checkpoint_root``), never to a machine-local one, so a
lost executor costs only the tasks it ran.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.session import checkpoint_root, release, ship_package  # noqa: F401 (release: for the operators)

#: Bytes of one Arrow batch sent to a Python worker (long texts make short batches).
BATCH_BYTES = 8 << 20
#: Distinct words a worker remembers; beyond it the memory starts anew (results are the same).
CACHE_WORDS = 300_000
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with the package on the workers and batches bounded in bytes."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(key: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves remainder 0 modulo 5 (a null id: true)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int) -> DataFrame:
    """(doc_id, text, y): at most ``rows`` labelled documents outside the held-out
    fold, taken by hash order of the id.

    The label side is bounded by ``rows`` and therefore broadcast; documents are
    never shuffled.  A label above 0 counts as 1, any other as 0; repeated label
    rows count once (the larger label).
    """
    lab = (labels.where(F.col(target).isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max((F.col(target) > 0).cast("int")).alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(lab), "doc_id"))


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h
