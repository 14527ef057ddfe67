"""Operator 13: phrase collocations by prefix-free parsing.

Texts are cut into pieces at marks and line ends, pieces into words.  A piece is
parsed into chunks: a window of ``OVERLAP`` words whose hash falls on a trigger
starts a new chunk, and a chunk goes on to the end of the window that starts the
next one.  Chunks depend on content alone, so repeated passages give the same
chunks wherever they stand, and the dictionary of distinct chunks with their
parse frequencies replaces the corpus.  Phrases have at most ``OVERLAP`` + 1
words, so each occurrence lies whole in the chunk that owns its first word; a
chunk owns all its words but the overlap at its end, and every occurrence is
counted once, weighted by the frequency of its chunk.

Phrases are counted level by level: one of m words is frequent only if its first
and its last m - 1 words are, so only such phrases are built, and from three words
on only chunks that hold such phrases are read again.  What passed the
last level travels as a bitmap of hashes of a fixed size (``FILTER_BITS``); a
false hit costs a row and nothing else, since the counts are of the phrases
themselves and exact at any size.

Everything is per language; a null language counts as ``und``.  Hot phrases,
chunks and languages are partial aggregates: in each worker first, then by map
tasks.  The report ranks within salted parts of a language before the whole.

Defined cases: null, empty and blank texts have no words; repeated rows count
each; ties are ordered by count and phrase; an empty table gives no phrases.
Ids and further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsflow.llm.common import CACHE_WORDS, arrow_map, mix64, release, stage

# Letters that are lower-cased, marks and line ends that end a piece, white space that ends a word.
BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
#: Words of the trigger window, and of the overlap of two chunks.
OVERLAP = 4
LONGEST = OVERLAP + 1
#: One window in this many starts a chunk.
SPACING = 16
MIN_COUNT, TOP = 100, 2000
#: Distinct pieces, and distinct phrases, that a worker adds up before it sends them on.
PIECES, PHRASES = 200_000, 1 << 21
#: Chunks whose words are numbered in one go.
ROWS = 60_000
#: Bits of the filter between two levels (8 MB).
FILTER_BITS = 26
#: Parts of a language that are ranked on their own first.
PARTS = 64
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
PARSED = "lang string, chunk string, owned long, times long"


class Split:
    """The words of some phrases: which of the batch's distinct (language, word) pairs each is."""

    def __init__(self, lang: pa.Array, phrases: pa.Array) -> None:
        words = pc.split_pattern(phrases, " ")
        self.size = np.diff(words.offsets.to_numpy())
        spelt, langs = words.flatten().dictionary_encode(), lang.dictionary_encode()
        many = max(1, len(spelt.dictionary))
        pair = np.repeat(langs.indices.to_numpy().astype(np.int64), self.size) * many + spelt.indices.to_numpy()
        if len(langs.dictionary) * many <= 8 * len(pair) + 1024:
            met = np.zeros(len(langs.dictionary) * many, bool)
            met[pair] = True
            each = np.flatnonzero(met)
            self.which = (np.cumsum(met) - 1)[pair]
        else:
            each, self.which = np.unique(pair, return_inverse=True)
        self.lang, self.word = langs.dictionary.take(pa.array(each // many)), spelt.dictionary.take(pa.array(each % many))
        by_word, by_lang = (hash_array(d.to_numpy(zero_copy_only=False), categorize=False) for d in (spelt.dictionary, langs.dictionary))
        self.hashes = mix64(by_word[each % many] ^ mix64(by_lang[each // many]))


def _windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` word hashes."""
    out = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for i in range(size):
        out = mix64(out * GOLDEN + h[i:i + len(out)])
    return out


def pieces(text: bytes) -> list[bytes]:
    """The pieces of a text: lower-cased, tabs as spaces; blank ones included."""
    return text.translate(BYTES).split(b"\n")


def chunks(lang: pa.Array, found: list[bytes], spacing: int = SPACING) -> tuple[Split, dict[int, list[tuple[bytes, int]]]]:
    """The words of each piece, and for those that do not stay one chunk (chunk, words
    it owns), overlapping by ``OVERLAP`` words.  Pieces have one blank between words."""
    split = Split(lang, _strings(found))
    end = np.cumsum(split.size)
    start = end - split.size
    trigger = np.flatnonzero(_windows(split.hashes[split.which], OVERLAP) % np.uint64(spacing) == 0)
    owner = np.searchsorted(end, trigger, side="right")
    inside = (trigger > start[owner]) & (trigger + OVERLAP <= end[owner])
    trigger, owner = trigger[inside], owner[inside]
    out = {}
    for i, places in zip(*_grouped(owner, trigger - start[owner])):
        words = found[i].split(b" ")
        cuts = [0, *places, len(words)]
        out[i] = [(b" ".join(words[a:b + OVERLAP]), b - a) for a, b in zip(cuts, cuts[1:])]
    return split, out


def _grouped(owner: np.ndarray, values: np.ndarray) -> tuple[list[int], list[list[int]]]:
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    return owner[first].tolist(), [x.tolist() for x in np.split(values, first[1:])] if len(first) else []


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _parse(spacing: int):
    def sent(held: Counter) -> Iterator[pa.RecordBatch]:
        rows: Counter = Counter()
        for (lang, piece), n in held.items():
            rows[lang, b" ".join(piece.split())] += n
        found = [key for key in rows if key[1]]
        if not found:
            return
        lang, piece = pa.array([f[0] for f in found], pa.string()), [f[1] for f in found]
        times = np.array([rows[f] for f in found])
        split, cut = chunks(lang, piece, spacing)
        whole = np.ones(len(found), bool)
        whole[list(cut)] = False
        count = np.bincount(split.which, np.repeat(times, split.size)).astype(np.int64)
        parts = [(chunk, owned, i) for i, made in cut.items() for chunk, owned in made]
        of = np.array([i for _, _, i in parts], np.int64)
        columns = {
            "lang": [lang.filter(pa.array(whole)), lang.take(pa.array(of)), split.lang],
            "chunk": [_strings(piece).filter(pa.array(whole)), _strings([c for c, _, _ in parts]), split.word],
            "owned": [pa.array(split.size[whole], pa.int64()), pa.array([n for _, n, _ in parts], pa.int64()), pa.array(np.zeros(len(count), np.int64))],
            "times": [pa.array(times[whole], pa.int64()), pa.array(times[of], pa.int64()), pa.array(count)]}
        yield pa.RecordBatch.from_pydict({n: pa.concat_arrays(c) for n, c in columns.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
                held.update((lang, piece) for piece in pieces(text or b"") if piece)
                if len(held) > PIECES:
                    yield from sent(held)
                    held.clear()
        yield from sent(held)
    return run


def dictionary(docs: DataFrame, spacing: int = SPACING) -> DataFrame:
    """(lang, chunk, owned, times): distinct chunks with their parse frequencies, and
    single words (``owned`` 0) with theirs, counted in the chunks that own them."""
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    return arrow_map(rows, _parse(spacing), PARSED).groupBy("lang", "chunk", "owned").agg(F.sum("times").alias("times"))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase), all of one length -> the filter's words and the bits set in them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        split = Split(batch.column("lang"), batch.column("phrase"))
        at = np.zeros(batch.num_rows, np.uint64)
        for column in split.which.reshape(batch.num_rows, -1).T:
            at = mix64(at * GOLDEN + split.hashes[column])
        at = at >> np.uint64(64 - FILTER_BITS)
        yield pa.RecordBatch.from_pydict({"word": pa.array((at >> np.uint64(6)).astype(np.int64)),
                                          "bits": pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))})


def _filter_of(frequent: DataFrame) -> np.ndarray:
    """Bitmap of the hashes of frequent phrases: at most 2 ** FILTER_BITS bits reach the driver."""
    found = (arrow_map(frequent.select("lang", "phrase"), _bits, "word long, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


class Tally:
    """Counts of phrases as rows of word numbers, two numbers to a 64-bit key; exact.
    Only words of counted phrases are numbered."""

    def __init__(self, m: int) -> None:
        self.m, self.number = m, {}
        self.keys, self.counts = np.zeros(((m + 1) // 2, 0), np.int64), np.zeros(0, np.int64)

    def add(self, split: Split, at: np.ndarray, times: np.ndarray) -> None:
        """Phrases that start at the words ``at``, so many times each."""
        met = np.zeros(len(split.hashes), bool)
        for i in range(self.m):
            met[split.which[at + i]] = True
        each = np.flatnonzero(met)
        named = zip(split.lang.take(pa.array(each)).to_pylist(), split.word.take(pa.array(each)).to_pylist())
        number = np.zeros(len(met), np.int64)
        number[each] = [self.number.setdefault(name, len(self.number)) for name in named]
        word = number[split.which]
        keys = [word[at + i] << 32 | (word[at + i + 1] if i + 1 < self.m else 0) for i in range(0, self.m, 2)]
        keys, counts = np.concatenate([self.keys, keys], axis=1), np.concatenate([self.counts, times])
        order = np.lexsort(keys[::-1])
        keys = keys[:, order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(order)), bool), (keys[:, 1:] != keys[:, :-1]).any(0)]))
        self.keys, self.counts = keys[:, first], np.add.reduceat(counts[order], first) if len(first) else counts

    def full(self) -> bool:
        return len(self.counts) > PHRASES or len(self.number) > CACHE_WORDS

    def sent(self) -> pa.RecordBatch:
        number = list(zip(*((self.keys[i // 2] >> 32 if i % 2 == 0 else self.keys[i // 2] & 0xFFFFFFFF).tolist() for i in range(self.m))))
        name = list(self.number)
        out = pa.RecordBatch.from_pydict({
            "lang": pa.array([name[n[0]][0] for n in number], pa.string()),
            "phrase": pa.array([" ".join([name[i][1] for i in n]) for n in number], pa.string()), "a": pa.array(self.counts)})
        self.__init__(self.m)
        return out


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined up to ``ROWS`` rows: the more chunks, the more of their words are known."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _count(m: int, known):
    """Occurrences of phrases of ``m`` words whose first and last ``m - 1`` words passed;
    from three words on also the chunks that may hold longer ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(m)
        for batch in _together(batches):
            if tally.full():
                yield tally.sent()
            split = Split(batch.column("lang"), batch.column("chunk"))
            size = split.size
            n = len(split.which)
            if n < m:
                continue
            first = np.cumsum(size) - size
            owner = np.repeat(np.arange(len(size)), size)[:n - m + 1]
            start = np.arange(len(owner)) - first[owner]
            hashed = _windows(split.hashes[split.which], m - 1) >> np.uint64(64 - FILTER_BITS)
            passed = (known.value[(hashed >> np.uint64(6)).astype(np.int64)] >> (hashed & np.uint64(63)) & np.uint64(1)).astype(bool)
            ok = passed[:-1] & passed[1:] & (start + m <= size[owner])
            owned = np.flatnonzero(ok & (start < batch.column("owned").to_numpy()[owner]))
            tally.add(split, owned, batch.column("times").to_numpy()[owner[owned]])
            if m > 2:
                longer = np.flatnonzero(ok[:-1] & ok[1:] & (owner[:-1] == owner[1:]))
                keep = pa.array(np.unique(owner[longer]))
                rows = {c: batch.column(c).take(keep) for c in ("lang", "chunk", "owned", "times")}
                yield pa.RecordBatch.from_pydict(rows | {"phrase": pa.nulls(len(keep), pa.string()), "a": pa.nulls(len(keep), pa.int64())})
        yield tally.sent()

    def with_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            if "chunk" not in out.schema.names:
                n = out.num_rows
                out = pa.RecordBatch.from_pydict({"lang": out.column("lang"), "chunk": pa.nulls(n, pa.string()), "owned": pa.nulls(n, pa.int64()),
                                                  "times": pa.nulls(n, pa.int64()), "phrase": out.column("phrase"), "a": out.column("a")})
            yield out
    return with_chunks if m > 2 else run


def frequent_phrases(parsed: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, m, a): all phrases of up to ``LONGEST`` words that stand ``min_count``
    times or more, from a staged dictionary."""
    spark: SparkSession = parsed.sparkSession
    counts = parsed.where("owned = 0").select("lang", F.col("chunk").alias("phrase"), F.col("times").alias("a"))
    levels = [stage(counts.where(F.col("a") >= min_count).withColumn("m", F.lit(1)), "phrase-level")]
    parsed = parsed.where("owned > 0")
    for m in range(2, LONGEST + 1):
        known = spark.sparkContext.broadcast(_filter_of(levels[-1]))
        if m == 2:
            counts = arrow_map(parsed, _count(m, known), "lang string, phrase string, a long")
        else:  # few chunks hold frequent pairs in a row; only they are read for the next level
            both = stage(arrow_map(parsed, _count(m, known), PARSED + ", phrase string, a long"), "phrase-pass")
            counts, parsed = both.where("phrase is not null"), both.where("phrase is null").select("lang", "chunk", "owned", "times")
        counts = counts.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
        levels.append(stage(counts.where(F.col("a") >= min_count).withColumn("m", F.lit(m)), "phrase-level"))
        known.unpersist()
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    whole = stage(out.select("lang", "phrase", "m", "a").repartition("lang", "phrase"), "phrases")
    release(out)
    return whole


def _first(words: Column, k: Column) -> Column:
    return F.array_join(F.slice(words, F.lit(1), k), " ")


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates: the lowest-scoring cut, ties to
    the smallest; ``totals``: (lang, n).  Exact (decimal) arithmetic."""
    words = F.split("phrase", " ")
    candidates = found.where("m >= 2")
    whole = candidates.withColumnRenamed("a", "whole_a")
    # a phrase goes if one longer by a word stands as often; of a still longer one, those between do too
    inner = whole.where("m >= 3").select("lang", F.explode(F.array(
        _first(words, F.col("m") - 1), F.array_join(F.slice(words, F.lit(2), F.col("m") - 1), " "))).alias("phrase"), "whole_a")
    covered = inner.groupBy("lang", "phrase").agg(F.max("whole_a").alias("most"))
    kept = candidates.join(covered, ["lang", "phrase"], "left").where("most is null or 100 * most < 100 * a")
    cuts = (kept.select("lang", "phrase", "m", "a", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", _first(words, F.col("k")).alias("left"),
                    F.array_join(F.slice(words, F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("right")))
    side = {s: found.select("lang", F.col("phrase").alias(s), F.col("a").alias(c)) for s, c in (("left", "l"), ("right", "r"))}
    cuts = cuts.join(side["left"], ["lang", "left"]).join(side["right"], ["lang", "right"]).join(totals, "lang")
    big = "decimal(19,0)"
    score = F.expr(f"(cast(1000 * a as {big}) * cast(n as {big})) div (cast(l as {big}) * cast(r as {big}))")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def top_phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    parsed = stage(dictionary(docs), "chunks")
    totals = stage(parsed.groupBy("lang").agg(F.sum(F.col("owned") * F.col("times")).alias("n")), "phrase-totals")
    found = scored(frequent_phrases(parsed, min_count), totals)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    near = (found.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top))
    return (near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
