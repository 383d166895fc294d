"""Exact selection against sorting, also where sketches err, and tops that only order what reaches them."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.operators import compare, metrics, selection


def rows(seed):
    draw = random.Random(seed)
    out = [("even", float(draw.randint(0, 5))) for _ in range(draw.randint(1, 60))] + [("wide", draw.gauss(0, 1) * 10 ** draw.randint(-5, 5)) for _ in range(3000)]
    out += [("one", 4.25), ("same", 1.5), ("same", 1.5), ("same", 1.5), (None, 2.0), (None, 3.0), ("none", None), ("even", None)]
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_quantiles(spark, monkeypatch, seed):
    if seed:  # a poor sketch, few steps: most ranks have to be looked for again
        monkeypatch.setattr(selection, "SKETCH", 8)
        monkeypatch.setattr(selection, "STEPS", 64)
    data, at = rows(seed), [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {r[0]: r for r in selection.quantiles(spark.createDataFrame(data, "g string, x double"), ["g"], "x", at).collect()}
    want = {}
    for g, x in data:
        if x is not None and g is not None:
            want.setdefault(g, []).append(x)
    assert set(got) == set(want)
    for g, values in want.items():
        assert got[g]["n"] == len(values)
        for i, q in enumerate(at):
            assert got[g][f"q{i}"] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_no_groups_and_no_rows(spark):
    df = spark.createDataFrame([(x,) for x in (5.0, 1.0, 3.0)], "x double")
    assert [tuple(r) for r in selection.quantiles(df, [], "x", [0.5]).collect()] == [(3, 3.0)]
    assert selection.quantiles(df.where("x > 9"), [], "x", [0.5]).collect() == []
    assert [tuple(r) for r in metrics.latency_percentiles(df, [], "x").collect()] == [(3.0, 4.8, pytest.approx(4.96), 5.0, 3.0)]


def test_latency_percentiles_keep_labels_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 7.0), ("b", None)], "label string, x double")
    got = {r["label"]: tuple(r)[1:] for r in metrics.latency_percentiles(df, ["label"], "x").collect()}
    assert got["a"][0] == 2.0 and got["b"] == (None, None, None, None, None) and got[None][3:] == (7.0, 7.0)


def test_many_values_of_a_label_have_no_buffer(spark):
    """A label's values are only counted: no aggregation that keeps them, and few of them are ordered."""
    df = spark.range(0, 2_000_000, 1, 8).select(F.lit("a").alias("label"), (F.col("id") * 7919 % 2_000_003).cast("double").alias("x"))
    seen = []

    def counted(rows, *order, **options):
        seen.append(rows.count())
        return pieced(rows, *order, **options)

    pieced, selection.pieced = selection.pieced, counted
    try:
        (row,) = selection.quantiles(df, ["label"], "x", [0.5, 0.99]).collect()
    finally:
        selection.pieced = pieced
    values = np.sort(np.arange(2_000_000) * 7919 % 2_000_003)
    assert row["q0"] == np.quantile(values, 0.5) and row["q1"] == np.quantile(values, 0.99)
    assert sum(seen) < 4 * 0.05 * 2_000_000


@pytest.mark.parametrize("ties", [False, True])
def test_tops(spark, ties):
    draw, data = random.Random(ties), []
    for s in "AB":
        for i in range(400):
            score = float(draw.randint(0, 3)) if ties else draw.random()
            data.append((s, i, score, draw.random()))
    df = spark.createDataFrame(data, "symbol string, time bigint, a_score double, b_score double")
    got = {(r["symbol"], r["time"]): r for r in compare.ranked(df, 0.05).collect()}
    k = math.ceil(0.05 * 400)
    for s in "AB":
        for d, at in (("a", 2), ("b", 3)):
            order = sorted((r for r in data if r[0] == s), key=lambda r: (-r[at], r[1]))
            assert [got[s, r[1]][f"{d}_place"] for r in order[:k]] == list(range(1, k + 1))
            assert all((s, r[1]) not in got or got[s, r[1]][f"{d}_place"] > k for r in order[k:])
    assert len(got) == 800 if ties is None else len(got) < 800
