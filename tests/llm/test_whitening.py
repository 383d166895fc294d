"""Whitening against numpy's own solver, exact sums in whole numbers, and odd tables."""

import random

import numpy as np
import pytest

from tideline.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, whitened int"


def vectors(n, d, seed=1):
    draw = np.random.default_rng(seed)
    mixed = draw.normal(size=(n, d)) @ draw.normal(size=(d, d)) * 0.3 + 5
    return mixed.astype(np.float32)


def saved(spark, tmp_path, rows, parts=7):
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def checked(out, kept):
    """The rows of a query against plain arithmetic over the vectors it should keep."""
    x = {i: [int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v] for i, v in kept}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - fit.mean(axis=0)
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis.T[::-1]
    many = min(16, int((values > 1e-9 * values[0]).sum()))
    by_id = {}
    for r in out:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(by_id) == set(x)
    first = next(iter(by_id.values()))
    signs = {}
    for i, comps in by_id.items():
        assert sorted(comps) == list(range(1, many + 1))
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x[i], sums, strict=True))
        for c, r in comps.items():
            want = (np.array(x[i]) - sums / n) @ basis[c - 1] / np.sqrt(values[c - 1])
            signs.setdefault(c, np.sign(r["whitened"] * want) if abs(want) > 1e-3 else 1)
            assert r["n"] == n and r["deviation"] == deviation
            assert r["whitened"] == pytest.approx(signs[c] * want, abs=1e-7)
            assert r["explained"] == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
            assert r["identity_error"] == first[1]["identity_error"] < 1e-9


def test_query_against_numpy(spark, tmp_path):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors(300, 20))]
    copies = [(1000 + i, rows[3][1], 0) for i in range(150)]
    odd = [(2000, None, 0), (2001, [1.0] * 19 + [None], 0), (2002, [float("nan")] * 20, 0), (2003, [float("inf")] * 20, 0), (2004, [1.0, 2.0], 0), (2005, [], 0), (2006, [3e38] * 20, 0)]
    all_rows = rows + copies + odd
    random.Random(1).shuffle(all_rows)
    out = whitening.op13_whitening(spark, saved(spark, tmp_path, all_rows)).collect()
    checked(out, [(i, v) for i, v, _ in rows + copies])


def test_fewer_dimensions_than_components_and_a_constant_one(spark, tmp_path):
    rows = [(i, [*v.tolist(), 2.5], 0) for i, v in enumerate(vectors(60, 4, 2))]
    checked(whitening.op13_whitening(spark, saved(spark, tmp_path, rows)).collect(), [(i, v) for i, v, _ in rows])


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)] * 3, [(1, None, 0)]])
def test_no_spread_no_rows(spark, tmp_path, rows):
    df = whitening.op13_whitening(spark, saved(spark, tmp_path, rows, 2))
    assert df.collect() == [] and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_states_merge_over_several_levels(spark):
    data = vectors(3000, 3)
    df = spark.createDataFrame([([int(c * 64) for c in v],) for v in data], "x array<bigint>").repartition(whitening.FAN * 2 + 5)
    state = whitening.moments(df, 3)
    whole = np.array([[int(c * 64) for c in v] for v in data])
    assert state.n == 3000 and state.sums == whole.sum(axis=0).tolist()
    np.testing.assert_allclose(state.covariance, np.cov(whole.T, bias=True), rtol=1e-12)


def test_symmetric_qr():
    draw = np.random.default_rng(3)
    for n in (1, 2, 3, 10, 64):
        for rank in (n, max(1, n // 2)):
            half = draw.normal(size=(n, rank)) * 10.0 ** draw.integers(-3, 4)
            a = half @ half.T
            values, vectors_ = whitening.symmetric_qr(a)
            np.testing.assert_allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * values[0] * n)
            np.testing.assert_allclose(vectors_ @ vectors_.T, np.eye(n), atol=1e-12)
            np.testing.assert_allclose(vectors_.T * values @ vectors_, a, atol=1e-12 * values[0] * n)
    values, _ = whitening.symmetric_qr(np.diag([2.0, 2.0, 5.0]))
    assert values.tolist() == [5.0, 2.0, 2.0]


def test_deviations_are_exact_beyond_a_long():
    model = whitening.Whitening(10**9, [7 * 10**18, -(10**17)], np.eye(2), np.ones(2), np.ones(2))
    far, squares = whitening._deviations(np.array([[7_000_000_001, -100_000_000], [10**13, 5]]), model)
    assert squares[0] == (10**9) ** 2 and squares[1] is None
    assert int(far[1][0]) == 10**22 - 7 * 10**18
