"""Operator 2: quality by a generalised additive model with pairwise interactions.

Shallow trees, boosted feature by feature in a cycle, fill one lookup table per
feature and one per chosen pair of features; a document's score is the sigmoid
of its table entries' sum, so scoring is binning and additions on whole batches.

Defined cases: a null text is scored as the empty text; a document with a null
id is held out; without labels of both kinds every score is the base rate (0.5
without labels at all); repeated rows are scored alike; further columns of
``docs`` are ignored.  Ids, languages, sources and labels are no features.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm import boosting as B
from newsflow.llm.common import arrow_map, held_out, labelled_sample, mix64, texts

#: At most so many labelled documents train the model.
SAMPLE_ROWS = 16_000
NAMES = ["log_chars", "log_words", "word_length", "letters", "capitals", "digits", "symbols", "exclaim", "pipes",
         "stops", "commas", "log_lines", "line_words", "short_lines", "repeated_lines", "ended_lines",
         "distinct_words", "top_word", "stutter", "repeated_triples", "spaces"]


def features(text: str) -> list[float]:
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    upper, lower, wide = raw[65:91].sum(), raw[97:123].sum(), raw[192:].sum()
    stops = raw[46] + raw[63]
    symbols = raw[33:127].sum() - upper - lower - raw[48:58].sum() - raw[46] - raw[44] - raw[63] - raw[33] - raw[124]
    lines = [ln for ln in text.split("\n") if ln and not ln.isspace()]
    m = max(1, len(lines))
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    triples = len(ids) - 2
    repeated = 0.0
    if triples > 0:
        key = mix64(ids[:-2] * np.uint64(3) + ids[1:-1] * np.uint64(5) + ids[2:] * np.uint64(7))
        repeated = 1 - len(np.unique(key)) / triples
    counts = Counter(words)
    return [np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / n, (upper + lower + wide) / chars,
            upper / chars, raw[48:58].sum() / chars, symbols / chars, raw[33] / n, raw[124] / n, stops / n, raw[44] / n,
            np.log1p(len(lines)), n / m, sum(len(ln) < 15 for ln in lines) / m, 1 - len(set(lines)) / m,
            sum(ln[-1:] in ".!?…\"" for ln in lines) / m, len(counts) / n ** 0.9,
            max(counts.values(), default=0) / n, float((ids[1:] == ids[:-1]).mean()) if len(ids) > 1 else 0.0,
            repeated, raw[32] / chars]


@dataclass
class QualityModel:
    gam: B.Gam | None = None
    base: float = 0.5

    def score(self, all_texts: list[str]) -> np.ndarray:
        if self.gam is None or not all_texts:
            return np.full(len(all_texts), self.base)
        return B.sigmoid(self.gam.raw(np.array([features(t) for t in all_texts])))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "y": batch.column("y"),
            "x": pa.array([features(t) for t in texts(batch)], pa.list_(pa.float64()))})


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = SAMPLE_ROWS) -> QualityModel:
    sample = labelled_sample(docs, labels, target, rows).select("doc_id", "text", "y")
    got = (arrow_map(sample, _featurise, "doc_id long, y int, x array<double>")
           .dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id"))
    y = got["y"].to_numpy(float)
    if len(set(y)) < 2:
        return QualityModel(base=float(y[0]) if len(y) else 0.5)
    return QualityModel(B.fit_gam(np.stack(got["x"].to_numpy()), y))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: one scan, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": model.score(texts(batch))})
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double")


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, rows: int = SAMPLE_ROWS) -> DataFrame:
    scored = score_quality(docs, train(docs, labels, rows=rows))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
