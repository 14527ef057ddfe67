"""The postings that propose the links left between components: joined once, none lost."""

import importlib
import random
import re
from itertools import combinations

import pytest

from newsflow.llm import superminhash
from test_operators import shingle_set

PERCENT = 80


def may_link(a, b):
    """Postings (row, root, n, place) of one shingle whose sizes and places allow a link."""
    small, large = sorted((a[2], b[2]))
    return (a[1] != b[1] and 100 * small >= PERCENT * large
            and (100 + PERCENT) * min(a[2] - a[3], b[2] - b[3]) >= PERCENT * (a[2] + b[2]))


def test_shared_posts_keep_every_pair_that_may_link(spark):
    rng = random.Random(4)
    posts = {}
    for s in range(400):
        held = rng.sample(range(1000), rng.choice([1, 2, 2, 2, 3, 5, 16, 17, 40]))
        roots, size = rng.choice([1, 2, 50]), rng.choice([10, 100])
        posts[s] = [(r, r % roots, n := size + rng.randrange(size // 2), rng.randrange(n // 5 + 1)) for r in held]
    df = spark.createDataFrame([(s, *p) for s, held in posts.items() for p in held],
                               "shingle long, row long, root long, n long, place long").repartition(3)
    got = {}
    for r in superminhash.shared_posts(df, PERCENT).collect():
        assert r.members == len(posts[r.shingle]) and r.hub == min(p[0] for p in posts[r.shingle])
        got.setdefault(r.shingle, []).append((r.row, r.root, r.n, r.place))
    for s, held in posts.items():
        pairs = [p for p in combinations(held, 2) if may_link(*p)]
        if s in got:
            assert sorted(got[s]) == sorted(held) and len({p[1] for p in held}) > 1
            assert pairs or len(held) > 2
        else:
            assert not pairs
    dropped = [s for s, held in posts.items() if len(held) == 2 and held[0][1] != held[1][1] and s not in got]
    assert dropped and sum(map(len, got.values())) < df.count()


@pytest.mark.parametrize("crowd", [2, 16])
def test_postings_meet_their_shingles_in_one_join(spark, monkeypatch, crowd):
    """A drifting chain whose rare links only the prefix filter finds; equal to all pairs."""
    plans = []

    def noting(module):
        write = module.stage

        def run(df, tag):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return write(df, tag)
        monkeypatch.setattr(module, "stage", run)
    noting(superminhash)
    noting(importlib.import_module("newsflow.llm.components"))
    monkeypatch.setattr(superminhash, "CROWD", crowd)
    words, rows = [f"w{i}" for i in range(200)], []
    for i in range(24):
        rows.append((i, " ".join(words)))
        words = words[9:] + [f"x{i}{j}" for j in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in superminhash.near_duplicates(df, 2, PERCENT, bands=6, rows=1).collect()}
    sets = [shingle_set(t, 2) for _, t in rows]
    best = list(range(len(rows)))
    for _ in rows:
        for i, j in combinations(range(len(rows)), 2):
            if 100 * len(sets[i] & sets[j]) >= PERCENT * len(sets[i] | sets[j]):
                best[i] = best[j] = min(best[i], best[j])
    assert got == dict(enumerate(best))
    joins = [line for plan in plans for line in plan.split("\n") if re.search(r"Join Inner, \(shingle#\d+L = shingle#\d+L\)$", line)]
    assert len(joins) == 1
