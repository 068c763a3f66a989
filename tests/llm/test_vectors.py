"""Operators on embeddings against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsgate.llm import hard_negatives as H
from obsgate.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, x string, anchor int, r int, n string"
NAN, INF = math.nan, math.inf


def frame(spark, rows, parts=3):
    """Rows with further columns named as the operators name theirs."""
    return spark.createDataFrame([(*r, "u", "x", 1, 2, "n") for r in rows], SCHEMA).repartition(parts)


def single(v):
    return [float(np.float32(c)) for c in v]


def brute_negatives(rows, n_pos=5, n_neg=3, low=50, high=95):
    kept = {(i, label, tuple(math.floor(256 * c) for c in single(v))) for i, v, label in rows if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)}
    size = max({len(x) for _, _, x in kept}, key=lambda d: (sum(len(x) == d for _, _, x in kept), d), default=0)
    kept = sorted(r for r in kept if len(r[2]) == size)
    out = []
    for a in kept:
        if a[0] % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a[2], b[2])), b[0], b[1]) for b in kept if b != a)
        for s, p, _ in [x for x in scored if x[2] == a[1]][:n_pos]:
            inside = [x for x in scored if x[2] != a[1] and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a[0], p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(inside[:n_neg])]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 50 == 0).collect())


def random_rows(seed, n, dims, spread=1.0, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dims)) * spread
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = rng.standard_normal(dims) * rng.choice([0.1, 1, 3]) + centres[label]
        out.append((i, v.tolist(), label))
    return out


@pytest.mark.parametrize("seed,dims,spread", [(1, 5, 0.0), (2, 17, 1.0), (3, 40, 0.3)])
def test_hard_negatives_match_brute_force(spark, seed, dims, spread, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 50)
    monkeypatch.setattr(H, "ANCHORS", 3)
    rows = random_rows(seed, 420, dims, spread)
    got = mined(frame(spark, rows))
    assert got == brute_negatives(rows) and len(got) > 20


def test_hard_negatives_ties_and_edges(spark):
    hot = [(i, [0.6, 0.8, 0.0], i % 3) for i in range(0, 400)]  # one vector: all scores tie
    odd = [
        (500, None, 1), (550, [], 1), (600, [0.1, None, 0.2], 1), (650, [0.1, NAN, 0.2], 1), (700, [INF, 0.1, 0.2], 1), (750, [0.1, 0.2], 1),
        (800, [0.3, 0.4, 0.5], None), (None, [0.9, 0.9, 0.9], 1), (850, [0.0, 0.0, 0.0], 1), (900, [-0.6, -0.8, 0.0], 2), (950, [0.3, 0.1, 0.9], 9),
        (950, [0.3, 0.1, 0.9], 9), (950, [0.9, 0.3, 0.1], 9), (951, [0.2, 0.1, 0.8], 9), (952, [1e-3, 0.5, 0.1], 7),
    ]
    rows = hot + odd
    assert mined(frame(spark, rows)) == brute_negatives(rows)
    assert mined(frame(spark, rows).limit(0)) == []
    assert mined(frame(spark, [(0, [1.0, 2.0], 1)])) == []  # no other row


def test_index_leaves_out_only_what_cannot_reach():
    rng = random.Random(5)
    x = np.array([[rng.randint(-300, 300) * (i % 4 == 0 or k < 3) for k in range(24)] for i in range(300)], np.int64)
    q = x[::9]
    index = H.Index(x)
    every = np.ones((len(q), len(x)), bool)
    exact = q @ x.T
    for share in (0.9, 0.5, 0.2, 0.0, -0.3):
        least = np.sqrt((q.astype(float) ** 2).sum(1)) * np.sqrt((x.astype(float) ** 2).sum(1)).max() * share
        a, j, s = index.pairs(q, least, every)
        assert {*zip(a.tolist(), j.tolist())} == {*zip(*map(list, np.nonzero(exact >= least[:, None])))}
        assert (s == exact[a, j]).all()


# --- whitening


def whitened(df, **options):
    return W.whiten(df, **options).collect()


def exact_whitening(rows, k=16):
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in single(v)]) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    dims = max({len(x) for _, x in kept}, key=lambda d: (sum(len(x) == d for _, x in kept), d))
    kept = [(i, x) for i, x in kept if len(x) == dims]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, sums = len(fit), fit.sum(0)
    c = fit - sums / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(k, dims, int((e > 1e-12 * e.sum()).sum()))
    z = (np.array([x for _, x in kept]) - sums / n) @ q[:, :k] / np.sqrt(e[:k])
    far = [sum((n * v - int(s)) ** 2 for v, s in zip(x, sums)) for _, x in kept]
    return kept, n, far, z, e[:k] / e.sum()


@pytest.mark.parametrize("n,dims", [(300, 50), (90, 70), (60, 6)])
def test_whitening_matches_exact_eigenvectors(spark, n, dims, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_BYTES", 4000)
    rng = np.random.default_rng(dims)
    scale = 1.3 ** -np.arange(dims) * 20 + 1
    rows = [(i, (rng.standard_normal(dims) * scale).tolist(), 0) for i in range(n)]
    rows += rows[:7] + [(None, rows[0][1], 1), (1000, None, 1), (1001, [], 1), (1002, [NAN] * dims, 1), (1003, [None] * dims, 1), (1004, [0.5], 1), (1005, [INF] + [0.0] * (dims - 1), 1)]
    got = whitened(frame(spark, rows))
    kept, size, far, z, share = exact_whitening(rows)
    assert len(got) == len(kept) * len(share) and {r.n for r in got} == {size}
    assert max(r.identity_error for r in got) < 1e-9
    want = sorted((-1 if i is None else i, d) for (i, _), d in zip(kept, far))
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.deviation) for r in got if r.component == 1) == want
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r.whitened
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
    mine = np.array([[by_id[i][c + 1] for c in range(len(share))] for i, _ in kept])
    assert np.abs(mine * np.sign((mine * z).sum(0)) - z).max() < 1e-7


def test_whitening_edges(spark):
    assert whitened(frame(spark, [(1, [0.1, 0.2], 0)]).limit(0)) == []
    assert whitened(frame(spark, [(1, [0.1, 0.2], 0), (2, [0.1, 0.2], 0)])) == []  # no variance
    got = whitened(frame(spark, [(1, [0.0, 1.0], 0), (2, [1.0, 1.0], 0), (2, [1.0, 1.0], 0)]))  # one dimension varies
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 12)), round(r.explained, 12)) for r in got) == [(1, 1, 1, 1), (2, 1, 1, 1), (2, 1, 1, 1)]
    far = whitened(frame(spark, [(i, [1e12 * i, float(i % 2)], 0) for i in range(4)]))
    assert {r.deviation for r in far} == {None} and max(r.identity_error for r in far) < 1e-6


@pytest.mark.parametrize("spectrum", ["flat", "steep", "equal", "cluster", "rank"])
def test_leading_is_certified(spectrum):
    d = 120
    values = {"flat": np.linspace(1, 1.2, d), "steep": 1 / np.arange(1, d + 1) ** 2, "equal": np.ones(d), "cluster": np.r_[np.full(40, 5.0), np.ones(d - 40)], "rank": np.r_[3.0, 2.0, np.zeros(d - 2)]}[spectrum]
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((d, d)))
    v = q * values @ q.T
    e, u = W.leading(lambda m: v @ m, d, 16)
    assert np.abs(e - np.sort(values)[::-1][:16]).max() < 1e-13 * values.max()
    assert np.linalg.norm(v @ u - u * e, axis=0).max() < 1e-12 * values.max()


def test_polynomial_damps_the_unwanted():
    values = np.linspace(0, 2, 41)
    out = W.filtered(lambda m: values[:, None] * m, np.eye(41), 0.0, 1.0, 2.0, 8)
    gain = np.diag(out)
    want = np.cos(8 * np.arccos(np.clip(2 * values - 1, -1, 1))) / np.cosh(8 * np.arccosh(3))
    assert np.allclose(gain[values <= 1], want[values <= 1]) and abs(gain[-1] - 1) < 1e-12
