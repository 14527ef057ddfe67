"""Operator 4: toxicity by gradient-boosted trees over dense features.

The lexicon is mined from the labelled sample (words and word beginnings that
occur almost only in toxic documents); the features of a document are lexicon
densities, lexicon hits near second-person words, capitals, punctuation and
obfuscation rates; the trees' output is calibrated by isotonic regression on
out-of-fold scores.

Defined cases: a null text is scored as the empty text; a document with a null
id is held out; without labels of both kinds every score is the base rate (0.5
without labels at all, and then :func:`drop_toxic` rejects nothing); repeated rows are scored alike; further columns of
``docs`` are ignored.  Ids, languages, sources and labels are no features.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm import boosting as B
from newsflow.llm.common import CACHE_WORDS, arrow_map, held_out, labelled_sample, stage, texts

#: At most so many labelled documents train the model.
SAMPLE_ROWS = 16_000
#: Second-person words of common languages.
SECOND_PERSON = frozenset("""
you your yours yourself u ur ya thou thee thy
du dich dir dein deine deinen deiner ihr euch euer
tu toi te ton ta tes vous votre vos
tú ti tus usted ustedes vosotros vuestro
""".split())
#: Characters that stand in for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "…“”‘’«»¡¿—–"
LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = range(3, 8)
STRONG, WEAK, HIDDEN, SECOND, CAPS, MIXED, SINGLE = (1 << i for i in range(7))
NAMES = ["log_words", "strong_hits", "strong_density", "weak_density", "hidden_hits", "hidden_density", "near_you",
         "near_you_density", "you_density", "caps_words", "caps_letters", "exclaim", "question", "punctuation",
         "mixed_words", "digits"]


@dataclass
class Lexicon:
    """Words and word beginnings (ending in ``*``) by strength."""

    strong: frozenset[str] = frozenset()
    weak: frozenset[str] = frozenset()

    def of(self, word: str) -> int:
        keys = [word, *(word[:k] + "*" for k in PREFIXES if len(word) >= k)]
        return STRONG if not self.strong.isdisjoint(keys) else WEAK if not self.weak.isdisjoint(keys) else 0


class Codes(dict):
    """Raw token -> bits; what a token's spelling says, remembered per worker."""

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        word = token.strip(EDGE)
        low = word.lower()
        bits = self.lexicon.of(low)
        if not word.isalpha():
            plain = "".join(LETTERS.findall(token.lower().translate(LEET)))
            if word and not bits and self.lexicon.of(plain) == STRONG:
                bits |= HIDDEN
            if any(c.isalpha() for c in word):
                bits |= MIXED
        if low in SECOND_PERSON:
            bits |= SECOND
        if len(word) > 1 and word.isupper():
            bits |= CAPS
        if len(word) == 1 and word.isalpha():
            bits |= SINGLE
        self[token] = bits
        return bits


def spaced_hits(tokens: list[str], single: np.ndarray, lexicon: Lexicon) -> int:
    """Lexicon words spelled as single letters with spaces between them."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    runs = [(a, b) for a, b in zip(edge[::2], edge[1::2]) if b - a >= 3]
    return sum(lexicon.of("".join(t.strip(EDGE).lower() for t in tokens[a:b])) == STRONG for a, b in runs)


def features(text: str, codes: Codes) -> list[float]:
    tokens = text.split()
    n = max(1, len(tokens))
    bits = np.fromiter(map(codes.__getitem__, tokens), np.int64, len(tokens))
    hit = (bits & (STRONG | HIDDEN)) > 0
    you = (bits & SECOND) > 0
    strong, weak, hidden = (int(((bits & b) > 0).sum()) for b in (STRONG, WEAK, HIDDEN))
    single = (bits & SINGLE) > 0
    if single.sum() >= 3:
        hidden += spaced_hits(tokens, single, codes.lexicon)
    near = 0
    if hit.any() and you.any():
        seen = np.concatenate([[0], you.cumsum()])
        at = np.flatnonzero(hit)
        near = int((seen[np.minimum(at + 6, len(you))] > seen[np.maximum(at - 5, 0)]).sum())
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    chars = max(1, len(text))
    punct = raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum()
    return [np.log1p(n), min(strong, 20), strong / n, weak / n, min(hidden, 20), hidden / n, min(near, 20), near / n,
            you.sum() / n, ((bits & CAPS) > 0).sum() / n, raw[65:91].sum() / chars, raw[33] / n, raw[63] / n,
            punct / chars, ((bits & MIXED) > 0).sum() / n, raw[48:58].sum() / chars]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word or a word beginning."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, y in zip(texts(batch), batch.column("y").to_pylist()):
            words = set(LETTERS.findall(text.lower()))
            counts[y].update(words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) >= k})
        terms = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_pydict({"term": terms, "bad": [counts[1][t] for t in terms],
                                          "good": [counts[0][t] for t in terms]})


def mine_lexicon(sample: DataFrame, size: int = 400, share: float = 0.01) -> Lexicon:
    """Terms held by at least ``share`` of the toxic sample texts, by precision.

    Equal texts count once, so a group of copies does not make its words lexical.
    """
    once = sample.dropDuplicates(["text", "y"])
    bad_docs = once.where("y = 1").count()
    found = (arrow_map(once, _count_terms, "term string, bad long, good long")
             .groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
             .where((F.col("bad") >= max(4, int(share * bad_docs))) & (F.col("bad") > 1.5 * F.col("good")))
             .orderBy(F.desc(F.col("bad") / (F.col("bad") + 4 * F.col("good") + 4)), "term").limit(size).collect())
    kept = [r for r in found if not any(_extends(o.term, r.term) and o.bad >= 0.9 * r.bad for o in found)]
    clean = frozenset(r.term for r in kept if r.bad >= 19 * r.good)
    return Lexicon(clean, frozenset(r.term for r in kept) - clean)


def _extends(longer: str, term: str) -> bool:
    """``term`` is a word beginning that ``longer`` continues (or the whole word)."""
    return term.endswith("*") and longer != term and longer.startswith(term[:-1])


#: Score where there are no labels to learn from.
UNKNOWN = 0.5


@dataclass
class ToxicityModel:
    lexicon: Lexicon = field(default_factory=Lexicon)
    trees: B.Gbt | None = None
    knots: np.ndarray = field(default_factory=lambda: np.zeros(1))
    values: np.ndarray = field(default_factory=lambda: np.full(1, UNKNOWN))

    def score(self, all_texts: list[str], codes: Codes) -> np.ndarray:
        if self.trees is None or not all_texts:
            return np.full(len(all_texts), self.values[0])
        x = np.array([features(t, codes) for t in all_texts])
        return np.clip(np.interp(self.trees.raw(x), self.knots, self.values), 0, 1)


def _featurise(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "y": batch.column("y"),
                "x": pa.array([features(t, codes) for t in texts(batch)], pa.list_(pa.float64()))})
    return run


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", rows: int = SAMPLE_ROWS) -> ToxicityModel:
    sample = stage(labelled_sample(docs, labels, target, rows).select("doc_id", "text", "y"), "toxic-sample")
    lexicon = mine_lexicon(sample)
    got = (arrow_map(sample, _featurise(lexicon), "doc_id long, y int, x array<double>")
           .dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id"))
    y = got["y"].to_numpy(float)
    if len(set(y)) < 2:
        return ToxicityModel(values=np.full(1, y[0] if len(y) else UNKNOWN))
    x = np.stack(got["x"].to_numpy())
    fold = np.arange(len(y)) % 3
    out = np.zeros(len(y))
    for k in range(3):
        out[fold == k] = B.fit_gbt(x[fold != k], y[fold != k]).raw(x[fold == k])
    return ToxicityModel(lexicon, B.fit_gbt(x, y), *B.fit_isotonic(out, y))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: one scan, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(model.lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                              "score": model.score(texts(batch), codes)})
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    scored = score_toxicity(docs, train(docs, labels, rows=rows))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the rows scored at or above the threshold; all columns kept."""
    model = train(docs, labels, rows=rows)
    if model.trees is None and model.values[0] == UNKNOWN:
        return docs
    fields = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(model.lexicon)
        for batch in batches:
            yield batch.filter(pa.array(model.score(texts(batch), codes) < threshold))
    return arrow_map(docs.select(*(F.col(f"`{f.name}`") for f in fields)), run, docs.schema)
