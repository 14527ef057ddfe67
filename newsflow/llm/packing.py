"""Operator 1: harmonic packing of token sequences.

Lengths fall into reciprocal-capacity classes: class k holds lengths in
(capacity/(k+1), capacity/k], and each of its bins takes exactly k pieces, so
classes fill their bins without looking at each other.  A document is first cut
into full sequences; its rest is cut so that every piece nearly fills a slot of
its class (at most ``slack`` of the slot is padding), which bounds padding by
``slack`` plus one open bin per class.

Workers number the pieces of each class on their own.  The counts per (worker,
class) - a few numbers per task - become starting ranks by a running sum, so
rank // k is the bin and rank % k the slot without gathering a class anywhere.

Defined cases: a null text is the empty text, whose document is the end id
alone; repeated rows and rows with a null id are packed as documents of their
own; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import CACHE_WORDS, arrow_map, stage, texts

CAPACITY = 2048
END_ID = 1
SLACK = 0.02


class WordTokenizer:
    """Ids of ``word_bpe_49k.json``, remembered by pre-token.

    For texts of Latin letters the normaliser only lower-cases and the
    pre-tokeniser's pattern is the one below, so pre-tokens are looked up and only
    new ones go through the tokenizer's model; any other text goes through the
    whole tokenizer.  Both give the tokenizer's own ids.
    """

    # Characters up to U+017F whose lower case stays among them; the tokenizer's pre-token pattern there.
    OTHER = re.compile("[^\x00-įı-ſ]|<\\|")
    LETTER = "a-zªµºß-öø-ÿā-ſ"
    PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[" + LETTER + "]+|[0-9²³¹¼½¾]|[^" + LETTER + "0-9²³¹¼½¾\t-\r \x85\xa0]+")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer.from_file(path)
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x180) if not chr(c).isspace() or c > 0x1b and c < 0x20}
        size = self.whole.get_vocab_size()
        self.last = np.zeros(size, bool)
        self.last[[i for t, i in self.whole.get_vocab().items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}  # little-endian unsigned 32-bit ids

    def _learn(self, new: list[str]) -> None:
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
        ids = np.array(self.model.encode(" ".join(new).translate(self.table | {32: " "}), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        packed, at = ids.tobytes(), 0
        for word, end in zip(new, (4 * ends).tolist(), strict=True):
            self.known[word] = packed[at:end]
            at = end

    def encode(self, text: str) -> np.ndarray:
        if not text.isascii() and self.OTHER.search(text) or "<|" in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        pieces = self.PIECES.findall(text.lower())
        try:
            return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), "<u4")
        except KeyError:
            wanted = set(pieces)
            self._learn([p for p in wanted if p not in self.known])
            if not wanted <= self.known.keys():  # the memory began anew
                self.known.clear()
                self._learn([*wanted])
            return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), "<u4")


@functools.lru_cache(1)
def worker_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer a worker process: its tables and memory serve all the tasks it runs."""
    return WordTokenizer(path)


def cut_lengths(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of a document's pieces, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if rest * k >= (1 - slack) * capacity:
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def _pieces(path: str, capacity: int, end_id: int, slack: float, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(path)
        seen: dict[int, int] = {}
        worker = TaskContext.get().partitionId()
        for batch in batches:
            rows = {n: [] for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "worker", "nth")}
            pieces = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                ids = np.append(tokenizer.encode(text), np.uint32(end_id)).astype("<u4", copy=False)
                start = 0
                for length in cut_lengths(len(ids), capacity, slack):
                    piece = ids[start:start + length]
                    k = capacity // length
                    nth = seen.get(k, 0)
                    seen[k] = nth + 1
                    for name, v in zip(rows, (doc_id, start, length, zlib.crc32(piece.tobytes()), len(ids), k, worker, nth)):
                        rows[name].append(v)
                    if with_ids:
                        pieces.append(piece.astype(np.int32))
                    start += length
            columns = {n: pa.array(v, pa.int64()) for n, v in rows.items()}
            yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(pieces, pa.list_(pa.int32()))} if with_ids else {}))
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and class (pieces per bin); with ``with_ids`` also the ids themselves."""
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class long, worker long, nth long"
              + ", ids array<int>" * with_ids)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    pieces = stage(arrow_map(docs, _pieces(tokenizer_path, capacity, end_id, slack, with_ids), schema), "pack-pieces")
    counts = pieces.groupBy("class", "worker").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("class", "worker", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["class", "worker"]).withColumn("rank", F.col("base") + F.col("nth"))
    binned = ranked.withColumn("sequence_id", F.shiftleft("class", 48).bitwiseOR(F.expr("rank div class")))
    slots = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return binned.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(slots), F.lit(0)).alias("offset"), "class",
                         *(["ids"] if with_ids else []))
