"""Operator 7: nearest neighbours by a permutation index.

A vector is represented by the order in which it sees a set of pivots, nearest
first, and posted in the inverted files of its nearest pivots.  A query reads the
files of its own nearest pivots, ranks their entries by footrule distance of the
two orders, and reranks the best by inner product in double precision.

Largest inner product becomes nearest neighbour by one more coordinate (the
square root of what a vector's squared norm lacks to the largest), so pivots and
orders also serve vectors of different lengths.

Scale: equal vectors are indexed once (a search needs at most ``k`` + 1 of their
ids, kept by a rank limit that prunes before the shuffle).  Files are dealt into
blocks of candidates and blocks of queries, so a hot pivot is many bounded tasks;
no file, candidate or query is capped.  A query that finds too few neighbours
reads all files.  Pivots are a bounded sample: ``pivots`` distinct vectors, by
default half the square root of the number of vectors, between 64 and 1024.

Defined cases: vectors that are null, zero, or hold null or non-finite components
take no part, nor do those of another length than the commonest (ties: the
larger).  Rows with a null id are ignored; a repeated id counts once per query,
with its nearest vector, and never as its own neighbour; a query id with several
vectors asks once for each and keeps the nearest.  Ties go to the smaller id.
Fewer candidates than ``k`` are all returned.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, stage
from newsflow.session import ship_package

#: Files a vector is posted in; share of the files that a query reads.
POSTED, PROBED = 2, 0.45
#: Rows of a block of candidates and of queries; share of a block that is reranked, and the least.
CANDIDATES, QUERIES = 2048, 512
RERANKED, AT_LEAST = 0.3, 256
#: Pivots that an order lists.
PREFIX = 128


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            if i is None or not v or None in v:
                continue
            x = np.asarray(v, np.float64)
            norm = float(x @ x)
            if np.isfinite(x).all() and norm > 0:
                raw = x.tobytes()
                rows.append((i, len(v), norm, xxhash.xxh128_digest(raw), raw))
        cols = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary()))],
            names=["vec_id", "dim", "norm2", "vkey", "v"])


def _orders(x: np.ndarray, norm2: np.ndarray, pivots: np.ndarray, largest: float, is_query: bool) -> np.ndarray:
    """Each row's pivots, nearest first (squared distance after the extra coordinate)."""
    extra = np.zeros(len(x)) if is_query else np.sqrt(np.maximum(largest - norm2, 0))
    near = x @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1] - 0.5 * (pivots ** 2).sum(1)
    return np.argsort(-near, axis=1, kind="stable")


def _post(pivots: np.ndarray, largest: float, files: int, is_query: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([np.frombuffer(b) for b in batch.column("v").to_pylist()])
            if not len(x):
                continue
            order = _orders(x, batch.column("norm2").to_numpy(), pivots, largest, is_query)
            kind = np.uint16
            yield pa.RecordBatch.from_arrays(
                [batch.column("vkey"), batch.column("v"),
                 pa.array([o.tobytes() for o in order[:, :PREFIX].astype(kind)], pa.binary()),
                 pa.array(list(order[:, :files].astype(np.int32)), pa.list_(pa.int32()))],
                names=["vkey", "v", "order", "files"])
    return run


def _ranks(orders: list[bytes], n_pivots: int) -> np.ndarray:
    """Place of every pivot in each order; pivots beyond the prefix share the last place."""
    order = np.array([np.frombuffer(o, np.uint16) for o in orders]).astype(np.int64)
    out = np.full((len(order), n_pivots), order.shape[1], np.int16)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.int16)[None].repeat(len(order), 0), 1)
    return out


def _search_block(n_pivots: int, keep: int):
    def run(key: tuple, cands: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"qkey": [], "ckey": [], "score": []}
        if len(cands) and len(queries):
            c = np.array([np.frombuffer(b) for b in cands["v"]])
            places = _ranks(list(cands["order"]), n_pivots)
            ckeys = cands["vkey"].to_numpy()
            best = max(AT_LEAST, keep, int(RERANKED * len(c)))
            for qkey, v, place in zip(queries["vkey"], queries["v"], _ranks(list(queries["order"]), n_pivots)):
                at = np.arange(len(c))
                if best < len(c):
                    footrule = np.abs(places - place).sum(1, dtype=np.int32)
                    at = np.argpartition(footrule, best)[:best]
                score = c[at] @ np.frombuffer(v)
                if len(at) > keep:
                    low = np.partition(score, len(score) - keep)[len(score) - keep]
                    at, score = at[score >= low], score[score >= low]
                out["qkey"] += [qkey] * len(at)
                out["ckey"] += list(ckeys[at])
                out["score"] += score.tolist()
        return pd.DataFrame(out)
    return run


def _blocks(posts: DataFrame, asks: DataFrame) -> DataFrame:
    """(file, c_blocks, q_blocks): one row per file that has both, at most the number of pivots."""
    n = posts.groupBy("file").agg(F.count("*").alias("n"))
    m = asks.groupBy("file").agg(F.count("*").alias("m"))
    return n.join(m, "file").select("file", F.ceil(F.col("n") / CANDIDATES).cast("int").alias("c_blocks"),
                                    F.ceil(F.col("m") / QUERIES).cast("int").alias("q_blocks"))


def _search(posts: DataFrame, asks: DataFrame, n_pivots: int, keep: int) -> DataFrame:
    """(qkey, ckey, score): of every block the best ``keep`` of each query."""
    blocks = F.broadcast(_blocks(posts, asks))
    c = (posts.join(blocks, "file")
         .withColumn("c", F.pmod(F.xxhash64("vkey"), F.col("c_blocks")).cast("int"))
         .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1))))
    q = (asks.join(blocks, "file")
         .withColumn("q", F.pmod(F.xxhash64("vkey"), F.col("q_blocks")).cast("int"))
         .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("c_blocks") - 1))))
    cols = ["file", "c", "q", "vkey", "v", "order"]
    ship_package(posts.sparkSession)
    return (c.select(*cols).groupBy("file", "c", "q").cogroup(q.select(*cols).groupBy("file", "c", "q"))
            .applyInPandas(_search_block(n_pivots, keep), "qkey binary, ckey binary, score double"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, pivots: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found in ``vectors`` of every
    (vec_id) in ``queries``, nearest first.  ``queries`` are ids of rows of ``vectors``."""
    valid = stage(arrow_map(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")),
                            _valid, "vec_id long, dim int, norm2 double, vkey binary, v binary"), "ann-vectors")
    dims = valid.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = dims[0].dim if dims else 0
    valid = valid.where(F.col("dim") == dim)
    n, largest = valid.agg(F.count("*"), F.max("norm2")).first()
    wanted = pivots or int(np.clip(0.5 * n ** 0.5, 64, 1024))
    sample = valid.orderBy(F.xxhash64("vkey", "vec_id"), "vec_id").limit(8 * wanted).select("vkey", "v", "norm2").collect()
    distinct = list({bytes(r.vkey): r for r in sample}.values())[:wanted]
    x = np.array([np.frombuffer(r.v) for r in distinct]).reshape(len(distinct), dim)
    points = np.column_stack([x, np.sqrt(np.maximum((largest or 0) - np.array([r.norm2 for r in distinct]), 0))])

    by_id = Window.partitionBy("vkey").orderBy("vec_id")
    members = stage(valid.withColumn("nth", F.dense_rank().over(by_id)).where(F.col("nth") <= k + 1), "ann-members")
    reps = members.where("nth = 1").dropDuplicates(["vkey"]).select("vkey", "v", "norm2")
    asked = valid.join(queries.select("vec_id").distinct(), "vec_id", "left_semi").select("vec_id", "vkey").distinct()
    asked = stage(asked, "ann-asked")
    q_reps = reps.join(asked.select("vkey").distinct(), "vkey", "left_semi")

    schema = "vkey binary, v binary, order binary, files array<int>"
    width = max(1, len(points))
    posts = arrow_map(reps, _post(points, largest or 0.0, POSTED, False), schema)
    posts = stage(posts.select("vkey", "v", "order", F.explode("files").alias("file")), "ann-posts")
    asks = stage(arrow_map(q_reps, _post(points, largest or 0.0, width, True), schema), "ann-asks")
    probe = max(1, int(np.ceil(PROBED * width)))

    def of(frame: DataFrame, files: int) -> DataFrame:
        return frame.select("vkey", "v", "order", F.explode(F.slice("files", 1, files)).alias("file"))

    best = Window.partitionBy("qkey").orderBy(F.desc("score"), "first_id")
    ids = members.groupBy("vkey").agg(F.min("vec_id").alias("first_id")).withColumnRenamed("vkey", "ckey")

    def top(found: DataFrame) -> DataFrame:
        found = found.groupBy("qkey", "ckey").agg(F.max("score").alias("score")).join(ids, "ckey")
        return found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).drop("at")

    found = stage(top(_search(posts, of(asks, probe), width, k + 1)), "ann-found")
    need = min(k + 1, reps.count())
    few = (asks.join(found.groupBy(F.col("qkey").alias("vkey")).agg(F.count("*").alias("got")), "vkey", "left")
           .where(F.coalesce("got", F.lit(0)) < need).drop("got"))
    if need and not few.isEmpty():
        again = top(_search(posts, of(stage(few, "ann-few"), width), width, k + 1))
        found = stage(found.unionByName(again).dropDuplicates(["qkey", "ckey"]), "ann-all")

    each = found.join(members.select(F.col("vkey").alias("ckey"), "vec_id"), "ckey")
    near = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    each = each.withColumn("at", F.row_number().over(near)).where(F.col("at") <= 2 * (k + 1)).select("qkey", "vec_id", "score")
    pairs = (asked.select(F.col("vec_id").alias("query_id"), F.col("vkey").alias("qkey")).join(each, "qkey")
             .where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(rank).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
