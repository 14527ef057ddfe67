"""Operator 12: embedding whitening by contour integration.

Vectors are quantised to long integers, each distinct one counts once, and the
components of their covariance are found by :mod:`newsflow.llm.feast`.  Every row
is then centred, projected on the components and scaled to unit variance.

Sums are exact integers; deviations n*x - S are formed before they are
multiplied, so nothing is lost to the size of the entries.  Each worker adds up
its part of the moments; the driver meets one number per dimension or pair of
dimensions.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries (or entries of 2^46 and more, whose quantised form is no exact double)
are left out, and so are those of another length than the commonest (ties: the
larger).  A null id is returned as null; repeated rows are each returned and
count once in the fit.  Components without variance beyond rounding are not
returned, so equal vectors, a single one and an empty table give no rows.  A
``deviation`` beyond 64 bits is null.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, stage
from newsflow.llm.feast import largest

COMPONENTS = 16
# Steps of one unit, and what is added to a step.
STEPS, SHIFT = 64, 1_000_000
EXACT = 1 << 62
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): floor(64 * c) + 1000000 of every entry of the rows that take part."""
    fits = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 46)))
    valid = (vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
             .where(fits & (F.size("v") > 0)))
    x = stage(valid.select("vec_id", F.transform("v", lambda c: F.floor(STEPS * c) + F.lit(SHIFT)).alias("x")), "white-rows")
    usual = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return x.where(F.size("x") == usual.d) if usual else x


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: 64-bit integers where they suffice, else Python's."""
    largest_x = max(int(x.max()), -int(x.min()))
    if n * largest_x + max(map(abs, sums)) < EXACT:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squared(d: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; null beyond 64 bits."""
    if d.dtype != object and int(np.abs(d).max()) ** 2 * d.shape[1] < EXACT:
        return (d * d).sum(1).tolist()
    return [s if s < 1 << 63 else None for s in (d.astype(object) ** 2).sum(1)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            n, total = n + len(x), total + x.astype(object).sum(0)
    if n:
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(range(len(total) + 1), pa.int32()),
            "total": pa.array([Decimal(int(t)) for t in [*total, n]], pa.decimal128(38, 0))})


def _moments(n: int, sums: list[int], onto: np.ndarray):
    """Sums of products of the deviations (over n), projected on the columns of ``onto``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                w = deviations(_matrix(batch), n, sums).astype(np.float64) / n @ onto
                held = w.T @ w if held is None else held + w.T @ w
        if held is not None:
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(held.size), pa.int32()), "total": pa.array(held.ravel())})
    return run


def _added(df: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size, object)
    for r in df.groupBy("place").agg(F.sum("total").alias("total")).collect():  # a row per dimension or pair of them
        out[r.place] = r.total
    return out


def moment(fit: DataFrame, n: int, sums: list[int], onto: np.ndarray) -> np.ndarray:
    """Covariance over the fit list, divisor n, of the deviations projected on ``onto``."""
    k = onto.shape[1]
    total = _added(arrow_map(fit, _moments(n, sums, onto), "place int, total double"), k * k)
    return total.astype(np.float64).reshape(k, k) / n


def _project(n: int, sums: list[int], onto: np.ndarray, share: np.ndarray, error: float):
    k = onto.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            d = deviations(_matrix(batch), n, sums)
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(each), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                "n": pa.array(np.full(rows * k, n)), "deviation": pa.array(squared(d), pa.int64()).take(each),
                "whitened": pa.array((d.astype(np.float64) / n @ onto).ravel()),
                "explained": pa.array(np.tile(share, rows)), "identity_error": pa.array(np.full(rows * k, error))})
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error."""
    rows = quantised(vectors)
    fit = stage(rows.select("x").distinct(), "white-fit")
    width = fit.select(F.size("x")).first()
    d = width[0] if width else 1
    *sums, n = map(int, _added(arrow_map(fit, _sums, "place int, total decimal(38,0)"), d + 1))
    covariance = moment(fit, n, sums, np.eye(d)) if n else np.zeros((d, d))
    value, vector = largest(covariance, components)
    if not len(value):
        return rows.sparkSession.createDataFrame([], SCHEMA)
    onto = vector / np.sqrt(value)
    error = float(np.abs(moment(fit, n, sums, onto) - np.eye(len(value))).max())
    return arrow_map(rows, _project(n, sums, onto, value / np.trace(covariance), error), SCHEMA)
