"""Operator 5: substring dedup by hashing normalised lines and runs of words.

Text goes where it stands earlier: a passage of at least ``min_words`` words, to
the word, wherever it begins and ends, and a whole line of any length.  Words are
normalised (A-Z lower-cased, ASCII white space collapsed); digests of lines and of
all runs of ``min_words`` words (grams) are grouped globally and the occurrence
with the smallest (doc_id, position) is kept.  Inside a text a gram counts as
repeated only behind the end of its first occurrence.

Few grams are shuffled.  The smallest hash of the ``SEED`` words runs in a gram is
its seed; neighbouring grams with one seed are a unit, which has one digest, as a
line has.  A unit that an earlier document holds is removed whole.  Only where a
seed has units of different content, as at the ends of a passage, the grams of
units not seen earlier are compared one by one.  That is exact: equal grams have
equal seeds, and the first document with a gram holds it in a unit that no earlier
document has.

Which seeds several documents hold, and which units are still open, travels as a
bitmap of hashes, ``BITS_EACH`` bits a seed and at most 2 ** ``MOST_BITS`` (64 MB);
a false hit costs a row, never a result, and a full bitmap costs no more than none.
Shuffled are units and grams that pass, as narrow rows with map-side aggregation
(a line that every document holds is one row per task), and each text once,
compressed, to meet the word ranges to remove.

Defined cases: null text stays null; empty and blank texts have no units; rows
with a null id neither lose nor claim text; rows under one id are one document,
so they never remove each other's text, while repetition inside a row goes.
Further columns are kept as they are, whatever their names, but ``removed``,
which is replaced; only ``text`` and, where it exists, ``n_chars`` change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.common import CACHE_WORDS, arrow_map, mix64, release, stage, texts
from newsflow.operators.skew import lookup

SEED, MIN_WORDS = 8, 20
LINE = np.uint64(0xC2B2AE3D27D4EB4F)
BASE = 0x9E3779B97F4A7C15 | 1
#: Bits of a filter for each key in it, and the most (as a power of two) a filter has.
BITS_EACH, MOST_BITS = 8, 29
#: A digest with more than this share of all rows is met where its rows lie.
SHARE = 1 / 1024
PLACED = "id long, tkey long, seed long, digest long, at long"


class UnitWords(dict):
    """word (bytes) -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BASE, -k, 1 << 64))])
        return self.up[:n], self.down[:n]


class Read:
    """The words of a text, as sums that give the digest of any run of them."""

    def __init__(self, text: str, words: UnitWords, powers: Powers) -> None:
        data = text.encode("utf-8", "surrogatepass").lower()
        tokens = data.split()
        self.n = n = len(tokens)
        self.line_at = np.unique(np.concatenate([[0], np.cumsum([len(line.split()) for line in data.split(b"\n")])]))
        up, self.down = powers.upto(n + 1)
        h = np.fromiter(map(words.__getitem__, tokens), np.uint64, n)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h) * up[:n], dtype=np.uint64)])

    def digests(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix64((self.total[b] - self.total[a]) * self.down[a] + (b - a).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        a = np.arange(max(0, self.n - size + 1))
        return self.digests(a, a + size)

    def lines(self) -> np.ndarray:
        return self.digests(self.line_at[:-1], self.line_at[1:]) ^ LINE

    def seeds(self, size: int) -> np.ndarray:
        """The seed of each gram."""
        k = min(SEED, size)
        low, width, w = self.grams(k), 1, size - k + 1
        if len(low) < w:
            return low[:0]
        while 2 * width <= w:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        return np.minimum(low[:len(low) - (w - width)], low[w - width:]) if width < w else low

    def units(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(seed, digest, first word, end) of every unit, then of every line (its own seed)."""
        seeds, line = self.seeds(size), self.lines()
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(seeds)), bool), seeds[1:] != seeds[:-1]]))
        end = np.append(first[1:], len(seeds))[:len(first)] + size - 1
        a, b = np.concatenate([first, self.line_at[:-1]]), np.concatenate([end, self.line_at[1:]])
        return (np.concatenate([seeds[first], line]), np.concatenate([self.digests(first, end), line]), a, b)

    def repeats(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, end) of the grams and lines that stand behind the end of their first occurrence."""
        grams = self.grams(size)
        at = np.arange(len(grams))
        a, b = np.concatenate([at, self.line_at[:-1]]), np.concatenate([at + size, self.line_at[1:]])
        _, index, inverse = np.unique(np.concatenate([grams, self.lines()]), return_index=True, return_inverse=True)
        again = b[index[inverse]] <= a
        return a[again], b[again]


def _longs(lists: list[np.ndarray]) -> pa.Array:
    return pa.array([x.view(np.int64) for x in lists], pa.list_(pa.int64()))


def _packed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First word and size of ranges, in one number each."""
    return a.astype(np.int64) << 32 | (b - a)


def _units(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, powers = UnitWords(), Powers()
        for batch in batches:
            seeds, digests, at, inner = [], [], [], []
            for text in texts(batch):
                r = Read(text, words, powers)
                seed, digest, a, b = r.units(size)
                seeds.append(seed)
                digests.append(digest)
                at.append(_packed(a, b))
                # a repeated gram repeats its seed, in another unit or in one that holds both
                twice = len(np.unique(seed)) < len(seed) or (b - a)[:len(a) + 1 - len(r.line_at)].max(initial=0) >= 2 * size
                inner.append(_packed(*r.repeats(size)) if twice else at[-1][:0])
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "tkey": batch.column("tkey"), "seeds": _longs(seeds), "digests": _longs(digests),
                "at": _longs(at), "inner": _longs(inner)})
    return run


class Filter:
    """Bitmap of the hashes of 64-bit keys."""

    def __init__(self, bits: int, word: np.ndarray, held: np.ndarray) -> None:
        self.shift = np.uint64(64 - bits)
        self.bitmap = np.zeros(1 << max(0, bits - 6), np.uint64)
        self.bitmap[word] = held.view(np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = mix64(keys.view(np.uint64)) >> self.shift
        return (self.bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def filter_of(keys: DataFrame) -> Filter:
    """The filter of a staged column ``key``; at most 2 ** MOST_BITS bits reach the driver."""
    bits = min(MOST_BITS, max(16, (BITS_EACH * keys.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = mix64(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)) >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_pydict({"word": pa.array((at >> np.uint64(6)).astype(np.int64)),
                                              "held": pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))})
    found = arrow_map(keys, run, "word long, held long").groupBy("word").agg(F.bit_or("held").alias("held")).toArrow()
    return Filter(bits, found.column("word").to_numpy(), found.column("held").to_numpy())


def _flat(batch: pa.RecordBatch, owner: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """Rows of (id, tkey) of the owners with further columns."""
    at = pa.array(owner)
    return pa.RecordBatch.from_pydict({"id": batch.column("id").take(at), "tkey": batch.column("tkey").take(at),
                                       **{n: pa.array(c.view(np.int64)) for n, c in columns.items()}})


def _shared(known):
    """(id, tkey, seed, digest, at) of the units whose seed passes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = {n: batch.column(c).flatten().to_numpy(zero_copy_only=False)
                    for n, c in (("seed", "seeds"), ("digest", "digests"), ("at", "at"))}
            owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("seeds").offsets.to_numpy()))
            ok = np.flatnonzero(known.value.has(flat["seed"]))
            yield _flat(batch, owner[ok], **{n: c[ok] for n, c in flat.items()})
    return run


def open_key(tkey: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    return tkey.view(np.uint64) ^ mix64(seeds.view(np.uint64))


def _open_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tkey, seed = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tkey", "seed"))
        yield pa.RecordBatch.from_pydict({"key": pa.array(open_key(tkey, seed).view(np.int64))})


def _grams(size: int, known):
    """(id, tkey, digest, at) of the grams of open units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, powers = UnitWords(), Powers()
        for batch in batches:
            owner, digest, at = [], [], []
            for i, (text, tkey) in enumerate(zip(texts(batch), batch.column("tkey").to_numpy(zero_copy_only=False))):
                r = Read(text, words, powers)
                a = np.flatnonzero(known.value.has(open_key(np.array([tkey]), r.seeds(size))))
                owner.append(np.full(len(a), i))
                digest.append(r.digests(a, a + size))
                at.append(_packed(a, a + size))
            if owner:
                yield _flat(batch, np.concatenate(owner), digest=np.concatenate(digest), at=np.concatenate(at))
    return run


def spans(text: str, ranges: np.ndarray) -> list[tuple[int, int]]:
    """Code point spans (end exclusive) of the words in ``ranges`` (first word << 32 | size),
    with the white space behind them, and the line end where a whole line goes."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (code == 32) | ((code >= 9) & (code <= 13))
    turns = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = turns[::2], turns[1::2]
    n = len(starts)
    first, size = ranges >> 32, ranges & 0xFFFFFFFF
    depth = np.bincount(first, minlength=n + 1) - np.bincount(first + size, minlength=n + 1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(depth) > 0).astype(np.int8), [0]])))
    out = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        start, end = int(starts[a]), int(ends[b - 1])
        after = int(starts[b]) if b < n else len(text)
        gap = text[end:after]
        if "\n" not in gap:
            end = after
        elif start == 0 or text[start - 1] == "\n":
            end += gap.index("\n") + 1
        out.append((start, end))
    return out


def _compressed():
    """Rows without ``text``, which goes compressed: it is what the shuffle to its ranges carries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            held = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_pydict({
                "rest": batch.column("rest"), "id": batch.column("id"), "tkey": batch.column("tkey"),
                "packed": pa.array([None if t is None else pack(t) for t in held], pa.binary())})
    return run


def _cut(names: list[str], rest: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            row, cuts = batch.column("rest"), batch.column("cuts")
            column = {n: row.field(i) for i, n in enumerate(rest)}
            kept = [None if t is None else unpack(t) for t in batch.column("packed").to_pylist()]
            removed = [[]] * batch.num_rows
            for i in np.flatnonzero(cuts.is_valid().to_numpy(zero_copy_only=False)).tolist():
                text = kept[i].decode("utf-8", "surrogatepass")
                cut = spans(text, cuts[i].values.to_numpy(zero_copy_only=False))
                at, parts = 0, []
                for a, b in cut:
                    parts.append(text[at:a])
                    at = b
                kept[i] = ("".join(parts) + text[at:]).encode("utf-8", "surrogatepass")
                removed[i] = [{"start": a, "end": b} for a, b in cut]
            column["text"] = pa.array(kept, pa.binary()).cast(pa.string())
            out = {n: column[n] for n in names}
            out["removed"] = pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_pydict(out)
    return run


def hot(counted: DataFrame, of: DataFrame) -> DataFrame:
    """The digests with more than ``SHARE`` of the rows of a staged table: fewer than 1 / SHARE."""
    return counted.where(F.col("rows") > F.lit(SHARE * of.count())).select("digest")


def repeated_ranges(keyed: DataFrame, size: int) -> DataFrame:
    """(id, tkey, cuts): the word ranges of a text that go; ``keyed``: id, tkey, text."""
    share = keyed.sparkSession.sparkContext.broadcast
    units = stage(arrow_map(keyed, _units(size), "id long, tkey long, seeds array<long>, digests array<long>, at array<long>, inner array<long>"),
                  "line-units")
    shared = (units.select("id", F.explode("seeds").alias("key")).groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
              .where("first < last").select("key"))
    shared = stage(shared, "line-shared")
    hits = stage(arrow_map(units.drop("inner"), _shared(share(filter_of(shared))), PLACED), "line-hits")
    inner = stage(units.where("size(inner) > 0").select("id", "tkey", F.col("inner").alias("cuts")).distinct(), "line-inner")
    release(units)
    release(shared)

    holders = stage(hits.groupBy("seed", "digest").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("rows")),
                    "line-holders")
    mixed = (holders.groupBy("seed").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.min("first").alias("first"),
                                         F.max("last").alias("last")).where("first < last and lo < hi").select("seed", F.lit(True).alias("mixed")))
    known = (holders.join(mixed, "seed", "left").where("first < last or mixed")
             .select("digest", "first", F.coalesce("mixed", F.lit(False)).alias("mixed")))
    met = lookup(hits, known, "digest", hot(holders, hits), "inner")
    met = met.select("id", "tkey", "at", (F.col("id") > F.col("first")).alias("seen"), "mixed", "seed")
    met = stage(met.where("seen or mixed").select("id", "tkey", F.when(F.col("seen"), F.col("at")).alias("at"), "seed"), "line-met")
    release(hits)
    release(holders)

    open_ = stage(arrow_map(met.where("at is null").select("tkey", "seed"), _open_keys, "key long").distinct(), "line-open")
    grams = stage(arrow_map(keyed, _grams(size, share(filter_of(open_))), "id long, tkey long, digest long, at long"), "line-grams")
    release(open_)
    first = grams.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("rows"))
    first = stage(first.where("first < last"), "line-first")
    exact = (lookup(grams, first.select("digest", "first"), "digest", hot(first, grams), "inner")
             .where("id > first").select("id", "tkey", "at"))
    ranges = met.where("at is not null").select("id", "tkey", "at").unionByName(exact)
    return (ranges.groupBy("id", "tkey").agg(F.collect_list("at").alias("cuts")).unionByName(inner)
            .groupBy("id", "tkey").agg(F.flatten(F.collect_list("cuts")).alias("cuts")))


def dedup_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; one more column, ``removed``:
    the cut spans as code point offsets into the original text."""
    fields = [f for f in docs.schema.fields if f.name != "removed"]
    names = [f.name for f in fields]
    rest = [n for n in names if n != "text"]
    other = [F.col(f"`{n}`") for n in rest]
    wide = docs.select(F.struct(*other).alias("rest"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64("text").alias("tkey"), "text")
    keyed = wide.select("id", "tkey", "text").where("id is not null and text is not null")
    cuts = repeated_ranges(keyed, min_words)
    span = T.StructType().add("start", T.LongType()).add("end", T.LongType())
    schema = T.StructType([*fields, T.StructField("removed", T.ArrayType(span))])
    packed = T.StructType([wide.schema["rest"], wide.schema["id"], wide.schema["tkey"], T.StructField("packed", T.BinaryType())])
    wide = arrow_map(wide, _compressed(), packed).join(cuts, ["id", "tkey"], "left").select("rest", "packed", "cuts")
    out = arrow_map(wide, _cut(names, rest), schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
