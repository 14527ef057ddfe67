"""The SQL of the near-duplicate query against brute force over all pairs."""

import random
import re

import duckdb

from newsflow.llm.near_sql import near_duplicates_sql

VOCAB = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu".split()


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def test_sql_equals_all_pairs():
    rng = random.Random(7)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "ONE"), (5, "one\x0btwo"), (6, "One  two")]
    base = [rng.choice(VOCAB) for _ in range(60)]
    for i in range(7, 60):
        if i % 10 == 0:
            base = [rng.choice(VOCAB) for _ in range(rng.randint(20, 90))]
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(VOCAB)
        rows.append((i, " ".join(words)))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = {r[0]: r[1:] for r in con.execute(near_duplicates_sql()).fetchall()}
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    same = [min(j for j in range(len(rows)) if sets[j] == s) if s else i for i, s in enumerate(sets)]
    assert len(set(root)) < len(rows) - 10
    assert got == {i: (len(sets[i]), root[i], root[i] == i, same[i]) for i in range(len(rows))}
