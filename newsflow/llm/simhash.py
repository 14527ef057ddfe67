"""Operator 11: SimHash near-duplicates by segment-popcount embedding.

A document's fingerprint has a bit set where over half of its word shingles'
64-bit hashes have it (repeats count).  Fingerprints link at ``BITS`` = 2 or
fewer differing bits.

A fingerprint is cut into segments and embedded as the vector of their bit
counts.  The Manhattan distance of two such vectors is at most the number of
differing bits, so linked fingerprints lie within 2 of each other on that grid,
and some grid point lies within 1 of both.  Each fingerprint is posted to the
grid points within 1 of it (at most 33 with 16 segments), points with few
members compare them in full, and a crowded point hands its members to a finer
grid: 32 segments, then 64, where a segment is one bit, the bound is the
distance itself, and whoever shares a point is linked.  There the members of a
point link to its smallest one, so a group of any size gives rows in proportion
to its members and never its pairs.  Every link is found by one of the grids.

Equal fingerprints are one node (a partial aggregate); what is posted, compared
and joined are distinct fingerprints, never texts.

Defined cases: null, empty and blank texts have fingerprint zero, linked like
any other; a text with fewer words than ``words`` has one shingle, its whole
sequence; repeated rows and ties have equal fingerprints and each row is
returned; a null id never becomes a ``component_id`` unless all ids of its
component are null.  Further columns of ``docs`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, release, stage, texts
from newsflow.llm.components import components
from newsflow.operators.skew import hot_keys, lookup

SEED, BITS = 42, 2
#: Bits of a segment on the grids, coarse to fine; the last one is exact.
WIDTHS = (4, 2, 1)
#: Members of a grid point that are compared pairwise; more go to the next grid.
CROWD = 16
#: Shingles hashed at a time.
CHUNK = 1 << 16
# Masks that add neighbouring bits and neighbouring pairs of bits.
ODD, PAIRS = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333)


def fingerprint(text: str, words: int) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    k = min(words, len(tokens))
    joined = b" ".join(tokens)
    ends = [e - 1 for e in accumulate(len(t) + 1 for t in tokens)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = len(tokens) - k + 1
    count = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED)
                      for a, b in zip(starts[at:min(at + CHUNK, n)], ends[at + k - 1:])], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "print": pa.array(found.view(np.int64))})
    return run


def embed(prints: np.ndarray, width: int) -> np.ndarray:
    """Bit counts of the segments of ``width`` bits, each in its own place of a 64-bit word."""
    if width >= 2:
        prints = prints - ((prints >> np.uint64(1)) & ODD)
    if width >= 4:
        prints = (prints & PAIRS) + ((prints >> np.uint64(2)) & PAIRS)
    return prints


def grid_points(prints: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, which fingerprint) for all grid points within Manhattan distance 1."""
    own = embed(prints, width)
    points, which = [own], [np.arange(len(own))]
    for i in range(0, 64, width):
        count = (own >> np.uint64(i)) & np.uint64((1 << width) - 1)
        for ok, point in ((count < width, own + np.uint64(1 << i)), (count > 0, own - np.uint64(1 << i))):
            points.append(point[ok])
            which.append(np.flatnonzero(ok))
    return np.concatenate(points), np.concatenate(which)


def _post(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy(zero_copy_only=False)
            point, which = grid_points(prints.view(np.uint64), width)
            yield pa.RecordBatch.from_pydict({"point": pa.array(point.view(np.int64)), "print": pa.array(prints[which])})
    return run


def linked(point: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the members of each point (rows sorted by point); a pair whose
    members both link to an earlier one is left out."""
    label = np.arange(len(point))
    a, b = [], []
    for lag in range(1, CROWD):
        i = np.flatnonzero(point[lag:] == point[:-lag])
        if not len(i):
            break
        i = i[np.bitwise_count((prints[i] ^ prints[i + lag]).view(np.uint64)) <= BITS]
        i = i[label[i] != label[i + lag]]
        a.append(i)
        b.append(i + lag)
        np.minimum.at(label, i + lag, label[i])
    return (prints[np.concatenate(x)] if x else prints[:0] for x in (a, b))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by point -> links; a point's rows may span batches."""
    point = prints = np.zeros(0, np.int64)
    for batch in batches:
        point, prints = (np.concatenate([held, batch.column(c).to_numpy(zero_copy_only=False)])
                         for held, c in ((point, "point"), (prints, "print")))
        done = int(np.searchsorted(point, point[-1])) if len(point) else 0
        a, b = linked(point[:done], prints[:done])
        point, prints = point[done:], prints[done:]
        yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})
    a, b = linked(point, prints)
    yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})


def links(prints: DataFrame) -> DataFrame:
    """(a, b): links that join all distinct fingerprints (``print``) within ``BITS`` bits."""
    active, found = prints, []
    for width in WIDTHS:
        posts = arrow_map(active, _post(width), "point long, print long")
        if width > 1:
            points = stage(posts.groupBy("point").agg(F.count("*").alias("members")).where("members > 1"), "sim-points")
            few = posts.join(points.where(F.col("members") <= CROWD).select("point"), "point")
            few = few.repartition("point").sortWithinPartitions("point")
            found.append(stage(arrow_map(few, _compare, "a long, b long").distinct(), "sim-links"))
            crowd = points.where(F.col("members") > CROWD).select("point")
            active = stage(posts.join(crowd, "point", "left_semi").select("print").distinct(), "sim-crowded")
            release(points)
        else:
            hubs = posts.groupBy("point").agg(F.min("print").alias("a"), F.max("print").alias("last")).where("a < last")
            found.append(posts.join(hubs.select("point", "a"), "point").where("print <> a")
                         .select("a", F.col("print").alias("b")).distinct())
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits) and
    component_id, the smallest id reachable over links of at most two bits."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = stage(arrow_map(docs, _sketch(words), "doc_id long, print long"), "sim-prints")
    distinct = stage(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "sim-distinct")
    roots = components(links(distinct.select("print"))).withColumnRenamed("row", "print")
    rooted = stage(distinct.join(roots, "print", "left").select("print", "first", F.coalesce("root", "print").alias("root")), "sim-roots")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    label = lookup(rooted, smallest, "root", hot_keys(rooted, "root")).select("print", "component_id")
    return lookup(rows, label, "print", hot_keys(rows, "print")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
