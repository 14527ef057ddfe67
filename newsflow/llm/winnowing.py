"""Operator 9: document fingerprints by winnowing.

Rolling hashes of all k-grams of code points; of every window of ``window``
consecutive hashes the smallest is chosen, the rightmost where hashes tie, and
its position kept.  Any passage of at least ``k + window - 1`` code points that
two texts share gives them a common hash, and no chosen hash matches on less than
``k`` equal code points.

Texts are compared with their neighbour in descending id: rows go to ranges of
ids, each range is one sorted stream, and each range also receives the first row
of the next one, so the text moves once.

Defined cases: null text counts as empty; an empty text has the empty
fingerprint; a text shorter than ``k`` has one hash, of the whole; fewer k-grams
than a window form one window.  Likeness is the Jaccard similarity of the sets of
hashes (1 for two empty fingerprints).  Rows with equal ids follow each other by
text hash; a null id comes last; a single row is its own neighbour.  Further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, mix64, texts

#: Shared passages from 15 code points on have a common hash: texts from 22 on, when a third is edited.
K, WINDOW = 8, 8
BASE = 0x9E3779B97F4A7C15 | 1
#: k-grams selected at a time; their places in a block fit the low bits of a key.
BLOCK_BITS = 20
HASH_BITS = 64 - BLOCK_BITS


class Winnower:
    """Fingerprints of texts; keeps the powers of the rolling hash's base."""

    def __init__(self, k: int = K, window: int = WINDOW) -> None:
        self.k, self.window = k, window
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BASE, -m, 1 << 64))])
        return self.up[:n], self.down[:n]

    def grams(self, text: str) -> np.ndarray:
        """Hashes of all k-grams, ``HASH_BITS`` wide."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = len(codes)
        if not n:
            return codes
        k = min(self.k, n)
        up, down = self._powers(n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * up, dtype=np.uint64)])
        return mix64((total[k:] - total[:-k]) * down[:n - k + 1]) >> np.uint64(BLOCK_BITS)

    def choose(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, positions) chosen, by position."""
        w, n = self.window, len(h)
        if not n:
            return h, np.zeros(0, np.int64)
        step = (1 << BLOCK_BITS) - w
        at = [self._block(h[a:a + step + w - 1]) + a for a in range(0, max(1, n - w + 1), step)]
        at = np.unique(np.concatenate(at)) if len(at) > 1 else at[0]
        return h[at], at

    def _block(self, h: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << BLOCK_BITS) - 1)
        low = (h << np.uint64(BLOCK_BITS)) | (mask - np.arange(len(h), dtype=np.uint64))
        width, w = 1, min(self.window, len(h))
        while 2 * width <= w:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < w:
            low = np.minimum(low[:len(low) - (w - width)], low[w - width:])
        # a gram is the least of windows in a row and of no later ones
        low = low[np.flatnonzero(np.concatenate([np.ones(min(1, len(low)), bool), low[1:] != low[:-1]]))]
        return (mask - (low & mask)).astype(np.int64)

    def fingerprint(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.choose(self.grams(text))


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    """hash:position of every chosen gram, the hash in hexadecimal."""
    pairs = np.stack([hashes, places.astype(np.uint64)], 1).ravel().tolist()
    return ("%x:%d," * len(hashes))[:-1] % tuple(pairs)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes."""
    h = np.sort(hashes)
    return h[np.concatenate([np.ones(min(1, len(h)), bool), h[1:] != h[:-1]])]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted distinct sets; of two empty ones, 1."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def edited_text(text: str, following: str) -> str:
    """The last third replaced by the first as many code points of the next text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes and positions of every row of ``docs``: one scan, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Winnower(k, window)
        for batch in batches:
            found = [w.fingerprint(t) for t in texts(batch)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "hashes": pa.array([f[0].view(np.int64) for f in found], pa.list_(pa.int64())),
                "positions": pa.array([f[1] for f in found], pa.list_(pa.int64()))})
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, hashes array<long>, positions array<long>")


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows of ``docs`` dealt to ranges of descending id, each sorted and followed by
    the first row of the next range (``halo``)."""
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)).alias("k"), F.xxhash64("text").alias("h"))
    ids = docs.select(F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit((1 << 63) - 1)).alias("k"))
    cuts = np.unique(ids.approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.25 / ranges))

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(np.float64), side="right").astype(np.int32))

    ranged = keyed.withColumn("range", range_of("k"))
    first = ranged.groupBy("range").agg(F.min(F.struct("k", "h")).alias("first")).collect()  # one row per range
    at = sorted(r.range for r in first)
    before = dict(zip(at, at[-1:] + at[:-1]))
    halo = docs.sparkSession.createDataFrame([(r.first.k, r.first.h, before[r.range]) for r in first],
                                             "k long, h long, before int")
    copies = ranged.join(F.broadcast(halo), ["k", "h"]).select(
        "doc_id", "text", "k", "h", F.col("before").alias("range"), F.lit(1).alias("halo"))
    both = ranged.select("doc_id", "text", "k", "h", "range", F.lit(0).alias("halo")).unionByName(copies)
    return both.repartition("range").sortWithinPartitions("range", "halo", "k", "h")


def _compare(k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Winnower(k, window)
        held = None  # the row whose next one is awaited: range, id, text, fingerprint
        for batch in batches:
            rows = []
            for range_, halo, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("range", "halo", "doc_id", "text"))):
                print_ = w.fingerprint(text)
                set_ = distinct(print_[0])
                if held and held[0] == range_:
                    _, own_id, own_text, own, own_set = held
                    edited = edited_text(own_text, text)
                    other = w.fingerprint(edited)
                    rows.append((own_id, len(own_text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                 written(*own), written(*other), likeness(own_set, distinct(other[0])), likeness(own_set, set_)))
                held = None if halo else (range_, doc_id, text, print_, set_)
            cols = list(zip(*rows)) or [[]] * 7
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[
                "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    return run


def compare_with_next(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and likeness to the latter and to the next row's."""
    ranges = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_map(with_next(docs, ranges), _compare(k, window),
                     "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
                     " near_edited double, near_next double")
