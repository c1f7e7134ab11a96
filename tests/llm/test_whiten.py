"""Whitening against numpy's dense eigenvectors and Python's integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from celltally.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_leading_pairs():
    rnd = np.random.default_rng(0)
    for values in (np.arange(40.0), np.r_[1e6, 1e6 - 1, np.ones(50), 1e-3], rnd.uniform(900, 1300, 64), np.r_[5.0, 5, 5, 1, 1], np.zeros(3), np.r_[2.0, 0, 0], np.ones(1)):
        q = np.linalg.qr(rnd.normal(size=(len(values), len(values))))[0]
        matrix = q * values @ q.T
        passes = []
        found, vectors = whiten.leading(lambda b, m=matrix, p=passes: p.append(1) or m @ b, len(values))
        k = min(4, len(values))
        assert np.allclose(found, np.sort(values)[::-1][:k], atol=1e-12 * max(1, values.max()))
        assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13)
        assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-12 * max(1, values.max())
        assert len(passes) < 200


def test_minres_solves_the_projected_equation():
    rnd = np.random.default_rng(1)
    a = rnd.normal(size=(30, 30))
    a = a + a.T
    q = np.linalg.qr(rnd.normal(size=(30, 3)))[0]
    project = lambda v: v - q @ (q.T @ v)
    b = project(rnd.normal(size=30))
    (t,) = whiten.side_by_side([whiten.minres(b, project, 0.3, 200, 1e-13)], lambda block: a @ block)
    assert np.allclose(project(a @ t - 0.3 * t), b, atol=1e-8) and np.allclose(q.T @ t, 0, atol=1e-9)


def brute(rows, wanted=4):
    kept = []
    for i, v, _ in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    lengths = [len(x) for _, x in kept]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n))
    kept = [(i, x) for i, x in kept if len(x) == d]
    fit = np.array(sorted({x for _, x in kept}), float)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(d, d))
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    sums = [sum(c) for c in zip(*{x for _, x in kept})]
    n = len(fit)
    out = {}
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        out.setdefault(i, []).append((deviation, (np.array(x) - fit.mean(0)) @ vectors / np.sqrt(values)))
    return n, out, values / np.trace(np.cov(fit.T, bias=True).reshape(d, d))


@pytest.fixture(scope="module")
def rows():
    rnd = np.random.default_rng(2)
    mix = rnd.normal(size=(9, 9))
    data = [(i, [float(np.float32(c)) for c in rnd.normal(size=9) @ mix], 1) for i in range(400)]
    data += [(1000 + i, data[0][1], 1) for i in range(200)]  # copies weigh once
    data += [(None, data[1][1], None), (5, data[2][1], 2), (2000, None, 1), (2001, [1.0] * 8 + [None], 1), (2002, [float("nan")] * 9, 1),
             (2003, [float("inf")] + [0.0] * 8, 1), (2004, [], 1), (2005, [1.0, 2.0], 1), (2006, [-0.0] * 9, 1), (2007, [-0.001] * 9, 1), (2008, [3e38] * 9, 1)]
    return data


def test_whitening(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("x", "whitened", "deviation", "n", "d", "vector"):
        df = df.withColumn(c, F.lit("clash"))
    out = whiten.report(df).collect()
    n, want, explained = brute([r for r in rows if r[0] != 2008])
    assert {r.n for r in out} == {n} and {r.vec_id for r in out} == set(want)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error <= 1e-9
    signs = {}
    for component in (1, 2, 3, 4):
        assert np.isclose(next(r.explained for r in out if r.component == component), explained[component - 1], rtol=1e-10)
    got = {}
    for r in out:
        got.setdefault(r.vec_id, []).append(r)
    for i, found in got.items():
        assert len(found) == 4 * len(want[i])
        assert sorted(r.deviation for r in found) == sorted(dev for dev, _ in want[i] for _ in range(4))
        if len(want[i]) == 1:
            for r in found:
                w = want[i][0][1][r.component - 1]
                sign = signs.setdefault(r.component, 1 if r.whitened * w >= 0 else -1)
                assert np.isclose(r.whitened, sign * w, rtol=1e-8, atol=1e-8)
    kept, _, values, _ = whiten.whitened(df)
    assert kept.columns == [*df.columns, values, "_deviation"] and values == "_whitened"


@pytest.mark.parametrize("data, components", [([], 0), ([(1, None, 1)], 0), ([(1, [], 1)], 0), ([(1, [1.0, 2.0], 1)] * 5, 0),
                                              ([(1, [1.0, 2.0, 0.5], 1), (2, [2.0, 4.0, 1.0], 1)], 1), ([(1, [1.0], 1), (2, [2.0], 1), (3, [4.5], 1)], 1)])
def test_few_rows(spark, data, components):
    out = whiten.report(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(out) == components * len(data)
    assert all(r.explained > 0.999 and r.identity_error < 1e-9 for r in out)


def test_exact_beyond_longs(spark):
    """Sums and deviations are exact; what no long holds is null."""
    big = float(1 << 44)
    out = whiten.report(spark.createDataFrame([(1, [big, 0.0]), (2, [-big, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: r.deviation for r in out} == {1: None, 2: None, 3: (3 * 1280 - 1536) ** 2}
