import math

import numpy as np
import pytest

from cdrflow.llm import queries as Q
from cdrflow.llm import whitening as W


def symmetric(values, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    a = (q * np.array(values)) @ q.T
    return (a + a.T) / 2


def test_pivots_count_the_signs():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 30):
        for _ in range(20):
            a = rng.standard_normal((n, n))
            a = a + a.T
            if rng.random() < 0.3:
                np.fill_diagonal(a, 0)  # needs 2 by 2 pivots
            e = np.linalg.eigvalsh(a)
            assert W.pivots(a) == ((e > 0).sum(), (e < 0).sum())
    assert W.pivots(np.zeros((3, 3))) == (0, 0)


@pytest.mark.parametrize("values", [
    [5.0, 4, 3, 2, 1], [3.0] * 6, [10, 10, 10, 1e-3, 1e-3, 0], [1 + 1e-12, 1, 1 - 1e-12, 0.5], list(np.geomspace(1e6, 1e-3, 40)),
    [7.0], [2.0, 0, 0],
], ids=["apart", "all equal", "clusters", "close", "wide", "one", "rank one"])
def test_pairs_are_those_of_the_matrix(values):
    a = symmetric(values, 3)
    pairs = W.leading_pairs(a, 16)
    want = sorted((v for v in values if v > 1e-12 * sum(values)), reverse=True)[:16]
    assert [p.value for p in pairs] == pytest.approx(want, rel=1e-9, abs=1e-13 * sum(values))
    v = np.array([p.vector for p in pairs])
    assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-12
    for j, p in enumerate(pairs, 1):
        assert np.linalg.norm(a @ p.vector - p.value * p.vector) < 1e-12 * sum(values)
        assert p.above[0] < j <= p.above[1]


def expected(rows):
    """By eigh, over Python integers."""
    x = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}), dtype=object)
    n, s = len(fit), fit.sum(0)
    centred = np.array([[(n * a - b) / n for a, b in zip(v, s)] for v in fit])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    for i, v in x:
        d = np.array([(n * a - b) / n for a, b in zip(v, s)])
        yield i, n, sum((n * a - b) ** 2 for a, b in zip(v, s)), d @ u / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def test_query_equals_eigh(spark, tmp_path):
    rng = np.random.default_rng(5)
    mix = rng.standard_normal((20, 20)) * np.geomspace(3, 0.2, 20)
    good = [(i, (rng.standard_normal(20) @ mix).astype(np.float32).tolist()) for i in range(200)]
    good += [(1000 + i, good[0][1]) for i in range(60)] + [(None, good[1][1]), (3, good[3][1])]
    odd = [(900, None), (901, [None] + [0.0] * 19), (902, [float("nan")] + [0.0] * 19), (903, [float("-inf")] + [0.0] * 19),
           (904, []), (905, [1.0, 2.0]), (906, [3e38] * 20)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in good + odd], "vec_id long, embedding array<float>, n int, x int").repartition(4)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = Q.op13_spectrum_whitening(spark, str(tmp_path)).collect()
    assert len(got) == 16 * len(good)
    signs = {}
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    for i, n, deviation, whitened, explained in expected(good):
        for c in range(1, 17):
            r = by_id[i][c]
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(explained[c - 1], rel=1e-10)
            assert r.identity_error < 1e-9
            sign = signs.setdefault(c, math.copysign(1, r.whitened * whitened[c - 1]))
            assert r.whitened == pytest.approx(sign * whitened[c - 1], abs=1e-8)


def test_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0  # one distinct vector
    line = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], schema)).collect()
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)


def test_deviation_is_exact_for_large_numbers():
    m = W.Whitening(3, [10**15, -5], 1.0, [])
    x = np.array([[2**40, 7], [333333333333333, -2]])
    assert m.deviations(x) == [v if (v := sum((3 * int(a) - s) ** 2 for a, s in zip(row, m.sums))) < 1 << 63 else None for row in x]
