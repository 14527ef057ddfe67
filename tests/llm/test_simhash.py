"""SimHash grids, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from newsflow.llm import simhash
from newsflow.llm.components import components

VOCAB = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def closed(prints):
    """Root index of each print over all links."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


ROWS = ([(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "ONE"), (5, "one two"), (6, prose(1, 400)), (7, prose(1, 400)),
         (None, prose(1, 400)), (None, "alone without id"), (9, "é ñ 漢字 Straße x y z"), (10, prose(2, 60_000))]
        + [(20 + i, prose(1, 400).replace("alpha", f"omega{i}", 1)) for i in range(30)]
        + [(60 + i, prose(3, 300 + i)) for i in range(30)] + [(60, prose(3, 300))])


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in ROWS], "doc_id long, text string, print int, point string, root int")
    got = sorted(map(tuple, simhash.near_duplicates(docs.repartition(3)).collect()), key=str)
    prints = [plain_print(t) for _, t in ROWS]
    root = closed(prints)
    smallest = {}
    for (i, _), r in zip(ROWS, root):
        smallest[r] = min((x for x in (i, smallest.get(r)) if x is not None), default=None)
    assert got == sorted(((i, f"{p:016x}", smallest[r]) for (i, _), p, r in zip(ROWS, prints, root)), key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = simhash.near_duplicates(docs)
    assert got.collect() == [] and got.columns == ["doc_id", "fingerprint", "component_id"]


@pytest.mark.parametrize("width", simhash.WIDTHS)
def test_linked_prints_share_a_grid_point_and_the_bound_is_low(width):
    rng = np.random.default_rng(width)
    prints = rng.integers(0, 1 << 64, 300, np.uint64)
    for flips in (0, 1, 2):
        other = prints.copy()
        for _ in range(flips):
            other ^= np.uint64(1) << rng.integers(0, 64, len(other), np.uint64)
        for a, b in zip(prints, other):
            one, two = (set(simhash.grid_points(np.array([x]), width)[0].tolist()) for x in (a, b))
            assert one & two
    counts = [[int(x) >> i & (1 << width) - 1 for i in range(0, 64, width)] for x in simhash.embed(prints, width)]
    segments = [[(int(p) >> i & (1 << width) - 1).bit_count() for i in range(0, 64, width)] for p in prints]
    assert counts == segments


def test_crowded_points_lose_no_link(spark):
    """A dense group (all pairs far beyond ``CROWD``), a chain of single bits, and noise."""
    rng = random.Random(5)
    base, chain = rng.getrandbits(64), rng.getrandbits(64)
    prints = {base}
    for i in range(64):
        prints.add(base ^ 1 << i)
        for j in range(0, i, 3):
            prints.add(base ^ 1 << i ^ 1 << j)
    for i in range(40):
        chain ^= 1 << i
        prints.add(chain)
    prints |= {rng.getrandbits(64) for _ in range(400)} | {0, 3, (1 << 64) - 1, (1 << 64) - 8}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long").repartition(3)
    got = {r.row: r.root for r in components(simhash.links(df)).collect()}
    want = closed(prints)
    groups = {}
    for s, r in zip(signed, want):
        groups.setdefault(r, []).append(s)
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(200, x) for x in range(201, 400)] + [(500, 500), (399, 7000)]
    got = {r.row: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(101)} | {i: 200 for i in range(200, 400)} | {7000: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
