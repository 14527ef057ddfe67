"""Whitening against numpy's own eigenvalues on the whole matrix, in exact integers where the result is one."""

import math

import numpy as np
import pytest

from newsflow.llm import feast, whitening

SCHEMA = "vec_id long, embedding array<double>, x int, component string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], SCHEMA).repartition(3)


def check(rows, got, components=16):
    valid = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in valid}))
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    centred = (n * fit - np.array(sums)) / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-12 * e.sum()).sum()))
    assert len(got) == len(valid) * k
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    want = sorted([(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), x) for i, x in valid], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for c in range(1, k + 1):
        mine = sorted(by[c], key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation))
        assert [(r.vec_id, r.deviation, r.n) for r in mine] == [(i, s, n) for i, s, _ in want]
        assert all(abs(r.explained - e[c - 1] / e.sum()) <= 1e-10 for r in mine)
        assert all(r.identity_error <= 1e-9 for r in mine)
        alone = min(abs(e[c - 1] - e[j]) for j in range(len(e)) if j != c - 1) > 1e-6 * e[0] if len(e) > 1 else True
        if alone:
            plain = np.array([(np.array(x) - np.array(sums) / n) @ q[:, c - 1] for _, _, x in want]) / np.sqrt(e[c - 1])
            mine_w = np.array([r.whitened for r in mine])
            assert np.abs(plain - mine_w * np.sign(plain @ mine_w)).max() < 1e-6


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=24) * np.arange(1, 25)).tolist()) for i in range(300)]
    rows += rows[:40] + [(1000, None), (1001, []), (1002, [1.0, None] + [0.0] * 22), (1003, [float("nan")] + [0.0] * 23),
                         (1004, [float("inf")] + [0.0] * 23), (None, rows[5][1]), (1005, [0.0] * 24)]
    check(rows, whitening.whiten(frame(spark, rows + [(2000, [1.0, 2.0])])).collect())


@pytest.mark.parametrize("rank", [0, 1, 5, 16])
def test_few_directions(spark, rank):
    rng = np.random.default_rng(rank)
    base = rng.integers(-9, 9, (rank, 20)).astype(float)
    rows = [(i, (rng.integers(-30, 30, rank) @ base).tolist() if rank else [2.0] * 20) for i in range(60)]
    got = whitening.whiten(frame(spark, rows)).collect()
    if rank:
        check(rows, got)
    else:
        assert got == []


def test_empty_and_single(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    check([(1, [1.0]), (2, [5.0])], whitening.whiten(frame(spark, [(1, [1.0]), (2, [5.0])])).collect())


def test_exact_beyond_64_bits():
    x = np.array([[1 << 51, 5], [-(1 << 51), 7]])
    n, sums = 1 << 20, [3, 12]
    d = whitening.deviations(x, n, sums)
    assert d.tolist() == [[n * int(a) - s for a, s in zip(row, sums)] for row in x]
    assert whitening.squared(d) == [None, None]
    assert whitening.squared(np.array([[3, 4], [1 << 30, 0]])) == [25, 1 << 60]


@pytest.mark.parametrize("spectrum", [
    np.arange(1, 65.0), np.ones(64), np.r_[np.full(20, 3.0), np.ones(44)], 2.0 ** -np.arange(64), np.r_[np.ones(17) + 1e-13 * np.arange(17), np.zeros(47)],
    np.r_[1e9, 1 + 1e-3 * np.arange(63)], np.linspace(100, 105, 64)])
def test_all_of_the_largest_are_found(spectrum):
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    value, vector = feast.largest(a, 16)
    true = np.sort(spectrum)[::-1][:16]
    true = true[true > 64 * 8 * feast.EPS * spectrum.sum()]
    assert len(value) == len(true)
    assert np.abs(value - true).max() <= 1e-13 * spectrum.sum()
    assert np.abs(vector.T @ vector - np.eye(len(value))).max() < 1e-12
    assert np.linalg.norm(a @ vector - vector * value, axis=0).max() <= 1e-12 * spectrum.sum()


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for d in (1, 2, 3, 30):
        a = rng.normal(size=(d, d))
        a += a.T
        shifts = np.linspace(-12, 12, 41)
        want = (np.linalg.eigvalsh(a)[None] > shifts[:, None]).sum(1)
        assert feast.above(feast.tridiagonal(a), shifts).tolist() == want.tolist()
