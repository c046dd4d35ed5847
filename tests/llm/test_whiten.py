import math
from fractions import Fraction

import numpy as np
import pytest

from tidelog.llm import spectrum as S
from tidelog.llm import whiten as W
from tidelog.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, x string, n string, component string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "clash", "clash", "clash") for i, v in rows], SCHEMA).repartition(parts)


def rotated(values, seed=0):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(d) - 0.5 * q.T @ q)
    a = (q * np.asarray(values, np.longdouble)) @ q.T
    return (a + a.T) / 2


def brute(rows):
    """Contract columns by fractions and a library's eigenvectors."""
    good = [(i, [min(max(math.floor(256 * c), -2 ** 63), 2 ** 63 - 1) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    dev = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)] for x in fit])
    v = dev.T @ dev / n
    values, vectors = np.linalg.eigh(v)
    out = {}
    for i, x in good:
        own = [n * c - s for c, s in zip(x, sums, strict=True)]
        y = np.array([float(Fraction(c, n)) for c in own])
        for k in range(min(4, len(values))):
            e = values[-1 - k]
            out.setdefault((i, k + 1), []).append((n, sum(c * c for c in own), abs(y @ vectors[:, -1 - k]) / math.sqrt(e),
                                                   e / v.trace()))
    return out


def same(df, want):
    got = {}
    for r in df.collect():
        assert r.identity_error <= 1e-4
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
    assert got.keys() == want.keys()
    for key, rows in want.items():
        for a, b in zip(sorted(got[key]), sorted(rows), strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-6, abs=1e-7)


@pytest.mark.parametrize("values", [
    np.linspace(1, 0.1, 20), np.ones(8), [3, 3, 3, 2, 2, *[0.5] * 10], [1, 1 - 1e-13, 0.5, 0.5 - 1e-15, 0.1],
    [5, 1e-9, 1e-10, 1e-11, 0, 0], [2.0], [1, 0, 0], [1, 0.5]])
def test_slicing_finds_numbered_orthogonal_pairs(values):
    a = rotated(values)
    pairs = S.leading(a, 4)
    want = [v for v in values if v > 1e-15 * sum(values)][:4]
    assert [float(p.value) for p in pairs] == pytest.approx(want, rel=1e-6) and all(p.certified for p in pairs)
    vectors = np.array([p.vector for p in pairs])
    assert np.abs(vectors @ vectors.T - np.eye(len(pairs))).max() < 1e-17
    assert all(np.abs(a @ p.vector - p.value * p.vector).max() < 1e-16 * max(values) for p in pairs)


def test_counts_follow_inertia():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 17):
        b = rng.normal(size=(d, d))
        a = b + b.T  # indefinite, with zero diagonals now and then
        a[np.arange(0, d, 2), np.arange(0, d, 2)] = 0
        for shift in (-1.0, 0.01, 0.3):
            f = S.factor(a, shift, 1.0)
            assert f.positive() == (np.linalg.eigvalsh(a) > shift).sum()
            assert (a - shift * np.eye(d)) @ f.solve(np.ones(d)) == pytest.approx(np.ones(d), abs=1e-6)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(200, 6)) * [3, 2, 1, 0.7, 0.2, 0.1] + [0, 1000, -5, 0, 0, 0]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(0, rows[5][1]), (None, rows[6][1]), *((1000 + i, rows[7][1]) for i in range(300))]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [math.nan] * 6), (903, [math.inf] + [0.0] * 5)]
    odd = [(904, []), (905, [1.0, 2.0])]
    same(W.whiten(frame(spark, rows + bad + odd)), brute(rows + bad))


def test_large_offsets_and_numbers_beyond_a_long(spark):
    rng = np.random.default_rng(2)
    far = [(i, [1e9 + float(v), float(w)]) for i, (v, w) in enumerate(rng.normal(size=(60, 2)))]
    got = W.whiten(frame(spark, far))
    same(got, brute(far))
    huge = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])]
    found = W.whiten(frame(spark, huge)).collect()
    assert {r.component for r in found} >= {1} and all(r.deviation is None or r.deviation < 10 ** 38 for r in found)


def test_moments_are_exact(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-2 ** 61, 2 ** 61, size=(50, 3)).tolist() + [[2 ** 62, -1, 5]]
    n, sums, products = W.moments(spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(4), 3)
    assert n == 51 and sums == [sum(c) for c in zip(*x, strict=True)]
    assert products == [[sum(r[i] * r[j] for r in x) for j in range(3)] for i in range(3)]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert W.whiten(frame(spark, rows)).count() == 0


def test_query(spark, folder):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))]
    df = frame(spark, rows)
    df.selectExpr("vec_id", "cast(embedding AS array<float>) AS embedding", "label").write.parquet(f"{folder}/embeddings.parquet")
    got = QUERIES["op13_embedding_whitening"](spark, folder)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    same(got, brute([(i, np.float32(v).astype(float).tolist()) for i, v in rows]))
