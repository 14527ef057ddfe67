"""Operator 10: language identification as inference of a language mixture.

Every byte trigram of a lower-cased text (letters and what joins them; other
ASCII characters count as a gap) comes from one of the learned languages.
Expectation-maximisation estimates each document's language proportions; the set
of languages is the one with the best likelihood less a penalty per language, and
the prediction is the largest proportion in that set.

The trigram tables are counted over at most ``rows`` documents of every language
outside the held-out fold, chosen by hash order of the id; documents are never
shuffled for prediction.  At most ``MOST_LANGUAGES`` languages are learned, so a
column of stray values bounds the tables; trigrams fall into 2 ** ``BITS`` classes.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
without any learned language so is every text; a null id is held out; repeated
rows are predicted alike; ties go to the language first in order; further columns
are ignored.  Ids, sources and the given language are no input of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, held_out, texts

SAMPLE_ROWS = 3_000
#: Most languages that are learned (those with the most documents): 128 KB of table each.
MOST_LANGUAGES = 1_000
#: Parts of a language whose ids are ranked on their own first.
PARTS = 64
BITS = 15
LETTER = re.compile(r"[^\W\d_]")
GAP = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
#: Trigram probabilities held at a time (trigrams x languages).
CELLS = 4_000_000
#: Natural-log units that one more language must gain per log of the text's trigrams.
PENALTY = 3.0
ROUNDS, SETTLED = 15, 2e-3


def grams(text: str) -> np.ndarray:
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(GAP) + b" ", np.uint8).astype(np.uint32)
    key = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    key = key[(b[1:-1] != 32) | (b[:-2] != 32)]
    return ((key * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int32)


@dataclass
class Languages:
    names: list[str]
    table: np.ndarray  # trigram class x language: probability

    def infer(self, all_texts: list[str]) -> list[tuple[str, float, list[tuple[str, float]]]]:
        """(language, its share, the chosen mixture) of every text."""
        out: list = [("und", 0.0, [])] * len(all_texts)
        known = [i for i, t in enumerate(all_texts) if t and self.names and LETTER.search(t)]
        group: list[int] = []
        lists: list[np.ndarray] = []
        total = 0
        for i in known:
            g = grams(all_texts[i])
            group.append(i)
            lists.append(g)
            total += len(g)
            if total * len(self.names) > CELLS or i == known[-1]:
                for j, found in zip(group, self._mixtures(lists)):
                    out[j] = found
                group, lists, total = [], [], 0
        return out

    def _em(self, p: np.ndarray, starts: np.ndarray, sizes: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log likelihood of each text; a share of zero stays zero."""
        share = share.copy()
        likely = np.zeros(len(sizes))
        live = np.arange(len(sizes))
        for round_ in range(ROUNDS):
            mixed = p * np.repeat(share[live], sizes[live], axis=0)
            total = mixed.sum(1)
            at = np.concatenate([[0], np.cumsum(sizes[live])[:-1]])
            likely[live] = np.add.reduceat(np.log(total), at)
            new = np.add.reduceat(mixed / total[:, None], at, axis=0) / sizes[live, None]
            moved = np.abs(new - share[live]).max(1)
            share[live] = new
            going = moved > SETTLED
            if not going.any():
                break
            if not going.all():
                p = p[np.repeat(going, sizes[live])]
                live = live[going]
        return share, likely

    def _mixtures(self, lists: list[np.ndarray]) -> list[tuple[str, float, list[tuple[str, float]]]]:
        n = len(self.names)
        sizes = np.array([len(g) for g in lists])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        p = self.table[np.concatenate(lists)]
        share, best = self._em(p, starts, sizes, np.full((len(lists), n), 1 / n, p.dtype))
        cost = PENALTY * np.log(sizes + 1)
        order = np.argsort(-share, axis=1, kind="stable")
        alone = np.add.reduceat(np.log(p), starts, axis=0)
        first = alone.argmax(1)
        chosen = np.zeros_like(share)
        chosen[np.arange(len(lists)), first] = 1
        value = alone[np.arange(len(lists)), first] - cost
        for k in range(2, n + 1):
            # a larger set can only win where the whole mixture's likelihood pays for it
            open_ = np.flatnonzero(best - k * cost > value)
            if not len(open_):
                break
            start = np.zeros((len(open_), n), p.dtype)
            np.put_along_axis(start, order[open_, :k], 1 / k, 1)
            rows = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in open_])
            got, likely = self._em(p[rows], starts, sizes[open_], start)
            better = likely - k * cost[open_] > value[open_]
            chosen[open_[better]] = got[better]
            value[open_[better]] = (likely - k * cost[open_])[better]
        out = []
        for row in chosen:
            top = int(row.argmax())
            mix = [(self.names[i], float(row[i])) for i in np.argsort(-row, kind="stable") if row[i] > 0]
            out.append((self.names[top], min(1.0, float(row[top])), mix))
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
            sums[lang] = sums.get(lang, 0) + np.bincount(grams(text), minlength=1 << BITS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                              "gram": pa.array(at, pa.int64()), "n": pa.array(n[at], pa.int64())})


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Languages:
    ids = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("doc_id", "lang")
    names = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).select("lang")
    ids = ids.join(F.broadcast(names), "lang").withColumn("part", F.pmod(F.xxhash64("lang", "doc_id"), F.lit(PARTS)))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    part, whole = (Window.partitionBy(*keys).orderBy(*order) for keys in (("lang", "part"), ("lang",)))
    taken = (ids.withColumn("nth", F.row_number().over(part)).where(F.col("nth") <= rows)
             .withColumn("nth", F.row_number().over(whole)).where(F.col("nth") <= rows)
             .select("doc_id", "lang").distinct())
    sample = (docs.where("text is not null").select("doc_id", "lang", "text")
              .join(F.broadcast(taken), ["doc_id", "lang"]).select("lang", "text"))
    got = (arrow_map(sample, _count, "lang string, gram long, n long")
           .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    names = sorted(got["lang"].unique())
    counts = np.full((1 << BITS, len(names)), 0.2)
    place = {name: i for i, name in enumerate(names)}
    counts[got["gram"].to_numpy(int), got["lang"].map(place).to_numpy(int)] += got["n"].to_numpy(float)
    return Languages(names, (counts / counts.sum(0)).astype(np.float32) if names else counts)


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, lang_pred, score and the mixture (language and share, largest first)."""
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.infer(texts(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([[{"lang": a, "share": s} for a, s in f[2]] for f in found], kind)],
                names=["doc_id", "lang_pred", "score", "mixture"])
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, lang_pred string, score double, mixture array<struct<lang:string,share:double>>")


def language_report(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    found = identify(docs, train(docs, rows))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score",
                        F.size("mixture").alias("n_languages"))
