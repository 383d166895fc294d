"""Both detectors, and the comparison of two."""

import math
import random
import statistics
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.functions import running
from tideline.operators import compare, detectors

T0 = datetime(2025, 5, 6, 7, 8, 9, tzinfo=UTC)
SCHEMA = "time timestamp, symbol string, trade_count int, notional double, spread_bps double, abs_return_bps double"


def ordinary(n, seed=0, spread=0.0031):
    """Rows of two symbols, with trades that vary, a spread that mostly stands still, and now and then something odd."""
    draw, rows = random.Random(seed), []
    for i in range(n):
        for symbol, size in (("P", 1.0), ("Q", 40.0)):
            odd = draw.random() < 0.03
            rows.append([T0 + timedelta(seconds=i), symbol, draw.randint(1, 9) * (7 if odd else 1), size * draw.uniform(300, 900) * (30 if odd else 1), spread * draw.choice([1] * 12 + [2, 6]), draw.expovariate(4)])
    return rows


def scored(spark, rows, **options):
    return detectors.zscores(detectors.vectors(spark.createDataFrame(rows, SCHEMA)), **options).orderBy("symbol", "time").collect()


def account(rows, window, least):
    """z-scores by the definition, one row after another; None while too few rows came before."""
    out, before = {}, {}
    for time, symbol, count, notional, spread, moved in rows:
        x = [math.log1p(count), math.log1p(notional), spread, math.log1p(moved)]
        own = before.setdefault(symbol, [])
        frame, z = own[-window:], None
        if len(frame) >= least:
            z = []
            for i, name in enumerate(detectors.NAMES):
                values = [f[i] for f in frame]
                mean = statistics.fmean(values)
                deviation = statistics.pstdev(values)
                deviation = 0.0 if deviation <= 1e-9 * max(1.0, abs(mean)) else deviation
                deviation = max(deviation, statistics.median(values) / 2) if name == "spread_bps" else deviation
                z.append((x[i] - mean) / deviation if deviation else 0.0)
        out[symbol, time] = z
        own.append(x)
    return out


@pytest.mark.parametrize("window,least,seed", [(40, 12, 0), (25, 25, 1), (300, 60, 2)])
def test_zscores_against_the_definition(spark, window, least, seed):
    rows = ordinary(110, seed)
    want = account(rows, window, least)
    got = scored(spark, rows, window=window, min_samples=least)
    assert len(got) == len(rows)
    for r in got:
        z = want[r.symbol, r.time.replace(tzinfo=UTC)]
        if z is None:
            assert r.score is None
        else:
            assert [r[f"z_{n}"] for n in detectors.NAMES] == pytest.approx(z, abs=1e-9)
            assert r.score == pytest.approx(max(map(abs, z)), abs=1e-9)
    flagged = detectors.flags(detectors.zscores(detectors.vectors(spark.createDataFrame(rows, SCHEMA)), window=window, min_samples=least, threshold=3.0), "zscore", z=True).collect()
    assert sorted((f.symbol, f.time.replace(tzinfo=UTC)) for f in flagged) == sorted(k for k, z in want.items() if z and max(map(abs, z)) > 3.0)
    for f in flagged:
        assert [f.features[f"z_{n}"] for n in detectors.NAMES] == pytest.approx(want[f.symbol, f.time.replace(tzinfo=UTC)], abs=1e-9)


def test_a_value_that_hardly_varies_has_no_score(spark):
    """Float noise isn't a deviation, and one z is the same row by row."""
    rows = [[T0 + timedelta(seconds=i), "P", 3, 0.1 + 0.2, 0.7, 0.3] for i in range(30)]
    rows[25][3] += 1e-12
    got = scored(spark, rows, window=20, min_samples=10)
    assert all(abs(r.score) < 1e-9 for r in got[10:])
    x = np.random.default_rng(0).normal(size=(60, 4)) + 3
    one = account([[i, "P", math.expm1(a), math.expm1(b), c, math.expm1(d)] for i, (a, b, c, d) in enumerate(x)], 40, 40)["P", 59]
    assert detectors.zscore_of(x[19:59], x[59]).tolist() == pytest.approx(one)


def test_chunks_change_nothing(spark, monkeypatch):
    rows = ordinary(130)
    whole = scored(spark, rows, window=40, min_samples=12)
    monkeypatch.setattr(running, "PIECE", 31)
    cut = scored(spark, rows, window=40, min_samples=12, chunk=50)
    assert [r.seen for r in cut] == [r.seen for r in whole] and [r.score for r in cut] == pytest.approx([r.score for r in whole])


def test_fit_schedule():
    """The closed form against a step-by-step account."""
    t, r, s = 30, 10, 4
    live, fits, want = None, [], {}
    for seen in range(1, 200):
        due = [j for f, j in fits if seen >= f + s]
        live = due[-1] if due else live
        if live is not None:
            want[seen] = live
        if seen >= t and (seen - t) % r == 0:
            fits.append((seen, len(fits)))
    assert want == {seen: (seen - t - s) // r for seen in range(t + s, 200)}


def test_forest(spark):
    """Scored from the row that the schedule says, the same again, and the same as each fit by itself."""
    rows = ordinary(300)
    v = detectors.vectors(spark.createDataFrame(rows, SCHEMA))
    options = {"train_window": 120, "refit_every": 50, "swap_after": 7, "trees": 15, "quantile": 0.9}
    run = lambda: detectors.forest_scores(v, **options).orderBy("symbol", "seen").collect()
    got = run()
    assert [(r.symbol, r.seen) for r in got] == [(s, n) for s in "PQ" for n in range(127, 301)]
    assert [r.score for r in run()] == [r.score for r in got]
    x = {s: np.array([[math.log1p(c), math.log1p(n), sp, math.log1p(m)] for _, sym, c, n, sp, m in rows if sym == s]) for s in "PQ"}
    for r in got[::25]:
        end = 120 + 50 * r.fit_id
        forest = detectors.IsolationForest(x[r.symbol][end - 120 : end], trees=15)
        assert r.fit_id == (r.seen - 127) // 50
        assert r.score == pytest.approx(float(forest.score(x[r.symbol][r.seen - 1 : r.seen])[0]))
        assert r.threshold == pytest.approx(float(np.quantile(forest.score(x[r.symbol][end - 120 : end]), 0.9)))


def test_forest_trees():
    """Every tree's leaves hold its rows, splits lie within their node, and far rows are isolated sooner."""
    draw = np.random.default_rng(3)
    data = np.concatenate([draw.normal(size=(200, 3)), np.full((40, 3), 1.0)])
    forest = detectors.IsolationForest(data, trees=20, subsample=64)
    size = len(forest.feature) // 20

    def walk(root, place, rows, level):
        at = root + place
        if forest.feature[at] < 0:
            assert level == forest.limit or len(rows) <= 1 or (rows == rows[0]).all() or forest.depth[at] >= level
            return 1
        own = rows[:, forest.feature[at]]
        assert level < forest.limit
        left = own < forest.cut[at]
        return walk(root, 2 * place + 1, rows[left], level + 1) + walk(root, 2 * place + 2, rows[~left], level + 1)

    assert all(1 < walk(r, 0, data, 0) <= 64 for r in forest.root) and size == (2 << forest.limit) - 1
    assert forest.score(np.array([[9.0, 9.0, 9.0]])) > np.quantile(forest.score(data), 0.95)
    same = detectors.IsolationForest(np.ones((10, 4)), trees=5)
    assert same.score(np.ones((2, 4))) == pytest.approx([0.5, 0.5])


def test_forest_rate():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 4))
    forest = detectors.IsolationForest(x[:1000], trees=50)
    limit = np.quantile(forest.score(x[:1000]), 0.99)
    assert 0.002 < (forest.score(x[1000:]) > limit).mean() < 0.03


def test_comparison(spark):
    draw = np.random.default_rng(0)
    a, b = draw.integers(0, 30, 300).astype(float), draw.integers(0, 30, 300).astype(float)
    rows = [(T0 + timedelta(seconds=i), "B", float(a[i]), bool(a[i] > 25), float(b[i]), bool(b[i] > 25), 1.0, 2.0, 3.0, 4.0) for i in range(300)]
    df = spark.createDataFrame(rows, "time timestamp, symbol string, a_score double, a_flag boolean, b_score double, b_flag boolean, " + ", ".join(f"x_{n} double" for n in detectors.NAMES))
    fa, fb = {i for i in range(300) if a[i] > 25}, {i for i in range(300) if b[i] > 25}
    o = compare.flag_overlap(df).first()
    assert (o.n_a, o.n_b, o.n_both) == (len(fa), len(fb), len(fa & fb)) and o.jaccard == pytest.approx(len(fa & fb) / len(fa | fb))
    near = {int((r.time.replace(tzinfo=UTC) - T0).total_seconds()) for r in compare.near_flags(df).withColumn("time", F.col("time").cast("timestamp_ntz")).collect()}
    assert near == {i for i in fa - fb if any(abs(i - j) <= 2 for j in fb)}
    rank = lambda x: np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])
    assert compare.spearman(df).first().rho == pytest.approx(np.corrcoef(rank(a), rank(b))[0, 1])
    top = lambda x: set(np.argsort(-x, kind="stable")[:3].tolist())
    assert [r.n_common for r in compare.topk_overlap(df).orderBy("rate").collect()][1] == len(top(a) & top(b))
    text = compare.report(df)
    assert [x for x in text.splitlines() if x.startswith("#")] == ["# Detector comparison"] + [f"## {x}" for x in ("Alarm rates", "Flags", "Top scores", "Rank correlation", "Feature percentiles", "Examples")]
    row = next(r for r in compare.percentile_ranks(df.withColumn("x_spread_bps", F.col("a_score"))).collect() if r.picked != "b_only")
    assert row.n_rows >= 1
    flags = df.where("a_flag").select("symbol", "time")
    assert tuple(compare.reproduced(flags, flags).first()) == (0, 0)
    assert tuple(compare.reproduced(flags, flags.limit(2).unionAll(df.where("not a_flag").select("symbol", "time").limit(3))).first()) == (len(fa) - 2, 3)
    assert tuple(compare.reproduced(flags.limit(0), flags.limit(0)).first()) == (0, 0)


def test_ranks_in_pieces(spark, monkeypatch):
    draw = random.Random(2)
    rows = [(T0 + timedelta(seconds=i), draw.choice("BC"), float(draw.randint(0, 9)), False, draw.random(), False, *[float(draw.randint(0, 5))] * 4) for i in range(200)]
    df = spark.createDataFrame(rows, "time timestamp, symbol string, a_score double, a_flag boolean, b_score double, b_flag boolean, " + ", ".join(f"x_{n} double" for n in detectors.NAMES))
    calls = (compare.topk_overlap, compare.spearman, compare.percentile_ranks, compare.top_examples)
    whole = [sorted(map(repr, f(df).collect())) for f in calls]
    monkeypatch.setattr(running, "PIECE", 13)
    assert [sorted(map(repr, f(df).collect())) for f in calls] == whole


def test_registered_forests_have_all_their_trees():
    from tideline.plans import adapter, replay

    assert adapter.SETTINGS.trees == replay.Settings().trees == 100
