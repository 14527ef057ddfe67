"""Phrase counts by chunks, scores and ranks against direct counting."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from newsflow.llm import collocations as C

VOCAB = [f"w{i}" for i in range(9)]


def prose(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(VOCAB) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"]) for _ in range(n))


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", low) if (w := re.findall(r"[^ \t]+", p))]


def report(rows, min_count, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for words in split(text):
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    f = {k: a for k, a in f.items() if a >= min_count}
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or any(g == lang and len(q) > len(p) and 100 * b >= 100 * a and
                             any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (g, q), b in f.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    rank, got = Counter(), []
    for r in out:
        rank[r[0]] += 1
        if rank[r[0]] <= top:
            got.append((r[0], rank[r[0]], *r[1:]))
    return got


def test_each_phrase_is_owned_once():
    rng = random.Random(3)
    for n in (1, 3, 4, 5, 6, 9, 40, 300):
        for spacing in (1, 2, 5, 1000):
            words = [rng.choice(VOCAB) for _ in range(n)]
            found = [b"w1 w2 w3 w4 w5", " ".join(words).encode(), b"w1 w2 w3 w4"]
            split, cut = C.chunks(pa.array(["en", "en", "fr"]), found, spacing)
            assert split.size.tolist() == [5, n, 4]
            before, made, after = (cut.get(i, [(f, len(f.split()))]) for i, f in enumerate(found))
            assert sum(owned for _, owned in before) == 5 and after == [(b"w1 w2 w3 w4", 4)]
            made = [(chunk.decode(), owned) for chunk, owned in made]
            assert sum(owned for _, owned in made) == n
            for m in range(1, C.LONGEST + 1):
                direct = Counter(tuple(words[i:i + m]) for i in range(n - m + 1))
                held = Counter()
                for chunk, owned in made:
                    w = chunk.split(" ")
                    held.update(tuple(w[i:i + m]) for i in range(min(owned, len(w) - m + 1)))
                assert held == direct


def test_chunks_depend_on_content_alone():
    rng = random.Random(4)
    words = [f"x{rng.randrange(500)}" for _ in range(400)]
    found = [" ".join(w).encode() for w in (words, [f"y{i}" for i in range(50)] + words)]
    cut = C.chunks(pa.array(["en", "en"]), found)[1]
    alone, moved = ({c for c, _ in cut[i]} for i in (0, 1))
    assert len(alone & moved) >= len(alone) - 2


@pytest.mark.parametrize("top", [2000, 7])
def test_report_against_direct_counts(spark, top):
    rows = ([("en", prose(i, 120)) for i in range(12)] + [("fr", prose(50 + i, 60)) for i in range(8)]
            + [(None, prose(1, 300)), ("en", None), ("en", ""), (None, " \n"), ("de", "One two three ONE TWO THREE. " * 20),
               ("en", "a a a a a a a a a a a a a a a a a a a a a a a a a a a a"), ("fr", "x " * 5000 + "é ñ 漢字 " * 30),
               ("en", prose(0, 120)), ("en", prose(0, 120)), ("it", "words said once only")])
    docs = spark.createDataFrame([(1, lang, text, "p", 5) for lang, text in rows],
                                 "doc_id long, lang string, text string, phrase string, times int").repartition(3)
    got = [tuple(r) for r in C.top_phrases(docs, min_count=10, top=top).orderBy("lang", "rank").collect()]
    assert got == report(rows, 10, top)


def test_empty_table_and_nothing_frequent(spark):
    for rows in ([], [("en", "just a few words")]):
        assert C.top_phrases(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000
    found = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 7), ("en", "a b", 2, big // 3)],
                                  "lang string, phrase string, m int, a long")
    totals = spark.createDataFrame([("en", 10 ** 13)], "lang string, n long")
    assert C.scored(found, totals).first()["score"] == 1000 * (big // 3) * 10 ** 13 // (big * (big - 7))
