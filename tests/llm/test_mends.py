"""Odd labels, names, sizes and skew in the corpus operators; brute force where SQL has no word for it."""

import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import boosting, langid, pii, quality, toxicity, winnowing
from test_operators import ROWS, prose


def masked_plainly(text, spans):
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_masking_keeps_columns_of_any_name(spark):
    many = " ".join(f"a{i}@b.co +49 30 12345{i:03d} x" for i in range(150))  # more than MANY spans
    rows = [(1, "mail a@b.co or 10.0.0.1", 5, "x"), (2, None, 6, "y"), (3, "é漢 " + many + " 漢", 7, "z"), (4, "", 8, ""), (5, "plain", 9, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_email int, row string").withColumns(
        {"pii_card": F.lit("mine"), "spans": F.lit(3), "n_chars": F.lit(0)})
    got = {r.doc_id: r for r in pii.mask_pii(df).collect()}
    assert pii.mask_pii(df).columns == df.columns
    for i, text, n, name in rows:
        r = got[i]
        assert (r.pii_email, r.row, r.pii_card, r.spans) == (n, name, "mine", 3)
        if text is None:
            assert r.text is None
            continue
        one = spark.createDataFrame([(text,)], "text string")
        found = pii.find_pii(one, prefix="_").first().asDict()
        spans = [(s.start, s.end, s.kind) for k in pii.PATTERNS for s in found[f"_{k}"]]
        assert r.text == masked_plainly(text, spans) and r.n_chars == len(r.text)


def test_spans_cost_in_proportion(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, " ".join(f"user{i}@example.org" for i in range(n)))], "doc_id long, text string").coalesce(1)
        best = math.inf
        for _ in range(3):
            t = time.time()
            r = pii.pii_report(df).first()
            pii.mask_pii(df).collect()
            best = min(best, time.time() - t)
        assert r.n_email == n
        first, last = r.spans.split(",")[0], r.spans.split(",")[-1]
        length = sum(len(f"user{i}@example.org") + 1 for i in range(n)) - 1
        assert first == "email:0:17" and last == f"email:{length - len(f'user{n - 1}@example.org')}:{length}"
        return best
    seconds(100)
    assert seconds(20_000) <= 2.6 * seconds(10_000) + 0.5


def test_running_totals(spark):
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 7, 8, 9, 100, 257):
        v = [rng.randrange(-50, 50) for _ in range(n)]
        df = spark.createDataFrame([(v,)], "v array<int>")
        got = df.select(pii.running(F.col("v"), lambda a, b: a + b).alias("s"), pii.running(F.col("v"), F.greatest).alias("m")).first()
        assert got.s == np.cumsum(v).tolist() and got.m == np.maximum.accumulate(v).tolist() if n else got.s == got.m == []


@pytest.mark.parametrize("report,target", [(toxicity.toxicity_report, "toxic"), (quality.quality_report, "quality")])
def test_odd_labels_and_texts_after_training(spark, report, target):
    """Labels other than 0 and 1, null, repeated and of unknown documents; odd texts scored by a trained model."""
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(240):
        bad = i % 2
        words = prose(i, 40).split()
        if bad:
            words[5:5] = ["you", "vile", "scum", "you", "rotten", "filth"] * 2
        docs.append((i, " ".join(words)))
        labels.append((i, rng.choice([1, 2, 7]) if bad else rng.choice([0, -3])))
    odd = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "z" * 200_000), (1004, "漢字 é"), (1005, "\x00\x01"), (None, "you vile scum")]
    labels += [(0, None), (3, 1), (9999, 1), (None, 1)]
    d = spark.createDataFrame([(i, t, "q", 3) for i, t in docs + odd], "doc_id long, text string, y string, x int")
    lab = spark.createDataFrame([(i, v) for i, v in labels], f"doc_id long, {target} int")
    got = {r.doc_id: r for r in report(d, lab).collect()}
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 for r in got.values())
    held = [r for r in got.values() if r.held_out and r.doc_id is not None and r.doc_id < 240]
    mean = {b: np.mean([r.score for r in held if r.doc_id % 2 == b]) for b in (0, 1)}
    assert mean[1] > mean[0] + 0.3
    again = {r.doc_id: r.score for r in report(d.orderBy(F.desc("doc_id")), lab.orderBy("doc_id")).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())


def test_additive_model_scores_are_table_sums():
    """The scorer against a plain loop over tables and pairs."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] + x[:, 1] * x[:, 2]) > 0).astype(float)
    gam = boosting.fit_gam(x, y, rounds=20, pair_rounds=20)
    raw = gam.raw(x[:50])
    bins = boosting.to_bins(x[:50], gam.edges)
    coarse = boosting.coarse_bins(bins, gam.tables.shape[1], gam.coarse)
    plain = [gam.base + sum(gam.tables[j][b[j]] for j in range(5)) + sum(t[c[i], c[j]] for (i, j), t in zip(gam.pairs, gam.pair_tables))
             for b, c in zip(bins, coarse)]
    assert np.abs(raw - plain).max() < 1e-9
    assert ((raw > 0) == (y[:50] > 0)).mean() > 0.8


def test_mixture_shares_equal_plain_expectation_maximisation(spark):
    """One text's chosen mixture against the textbook update on its trigram table."""
    texts = {"aa": "abab abba baab aabb bbaa abaa " * 20, "cc": "cdcd cddc dccd ccdd ddcc cdcc " * 20, "ee": "efef effe feef eeff ffee efee " * 20}
    docs = [(i, t, lang) for i, (lang, t) in enumerate(list(texts.items()) * 4)]
    docs += [(100, texts["aa"][:120] + texts["cc"][:240], None), (101, None, "aa"), (102, "123", None), (103, texts["ee"] * 50, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.train(df)
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert got[101].lang_pred == got[102].lang_pred == "und" and got[103].lang_pred == "ee"
    p = model.table[langid.grams(docs[12][1])].astype(float)
    chosen = [model.names.index(m.lang) for m in got[100].mixture]
    assert sorted(model.names[i] for i in chosen) == ["aa", "cc"] and got[100].lang_pred == "cc"
    share = np.full(len(chosen), 1 / len(chosen))
    for _ in range(500):
        part = p[:, chosen] * share
        share = (part / part.sum(1, keepdims=True)).mean(0)
    assert np.abs(share - [m.share for m in got[100].mixture]).max() < 0.02


def test_stray_languages_bound_the_tables(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    docs = [(i, f"alpha beta gamma {i}", "en") for i in range(30)] + [(100 + i, f"delta epsilon {i}", "fr") for i in range(20)]
    docs += [(200 + i, "stray", f"x{i}") for i in range(40)]
    model = langid.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"), rows=5)
    assert model.names == ["en", "fr"]


def plain_winnow(text, k, window):
    """(hash, place) chosen: the least of every window, the rightmost of equals."""
    h = winnowing.Winnower(k, window).grams(text).tolist()
    if not h:
        return []
    w = min(window, len(h))
    at = sorted({max(j for j in range(i, i + w) if h[j] == min(h[i:i + w])) for i in range(len(h) - w + 1)})
    return [(h[j], j) for j in at]


def test_winnowed_likeness_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in ROWS if i is not None and not (t and len(t) > 4000)], "doc_id long, text string")
    rows = sorted({(r.doc_id, r.text or "") for r in docs.collect()}, key=lambda r: -r[0])
    got = {(r.doc_id, r.n_chars): r for r in winnowing.compare_with_next(docs.dropDuplicates()).collect()}
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        r = got[i, len(text)]
        n = len(text) // 3
        edited = text[:len(text) - n] + following[:n]
        own, other, after = (plain_winnow(t, winnowing.K, winnowing.WINDOW) for t in (text, edited, following))
        assert r.fingerprint == ",".join(f"{h:x}:{p}" for h, p in own)
        assert r.edited_fingerprint == ",".join(f"{h:x}:{p}" for h, p in other)

        def like(a, b):
            a, b = {h for h, _ in a}, {h for h, _ in b}
            return len(a & b) / len(a | b) if a | b else 1.0
        assert abs(r.near_edited - like(own, other)) < 1e-12 and abs(r.near_next - like(own, after)) < 1e-12
