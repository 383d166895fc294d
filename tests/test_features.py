"""Feature buckets on generated events against a plain account, batch against stream, and restarts of the stream."""

import math
import os
import random
import time
from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest

from tideline.functions import running
from tideline.operators import features
from tideline.operators.features import build_features
from tideline.streaming.live import LiveBuckets

T0 = datetime(2025, 3, 4, 5, 6, 7, tzinfo=UTC)
S0 = int(T0.timestamp())


def events(seed, n=120, steps=(0.1, 0.4, 1.2, -0.7, 3.0, 9.5)):
    """(seconds, symbol, "t", price, quantity) or (seconds, symbol, "q", bid, ask); clocks go back, and there are silences."""
    draw, now, out = random.Random(seed), 0.0, []
    for _ in range(n):
        now = max(0.0, now + draw.choice(steps))
        bid = round(draw.uniform(90, 110), 2)
        a, b = (round(draw.uniform(1, 9), 2), 2.5) if draw.random() < 0.4 else (bid, round(bid + draw.uniform(0.1, 1), 2))
        out.append((round(now, 3), draw.choice("XYZ"), "t" if b == 2.5 else "q", a, b))
    return out


def built(spark, rows, **options):
    at = lambda s: T0 + timedelta(microseconds=round(s * 1e6))
    t = [(i, at(s), sym, Decimal(str(a)), Decimal(str(b))) for i, (s, sym, k, a, b) in enumerate(rows) if k == "t"]
    q = [(i, at(s), sym, float(a), float(b)) for i, (s, sym, k, a, b) in enumerate(rows) if k == "q"]
    trades = spark.createDataFrame(t, "seq long, received_at timestamp, symbol string, price decimal(18,8), qty decimal(18,8)")
    quotes = spark.createDataFrame(q, "seq long, received_at timestamp, symbol string, bid double, ask double")
    got = build_features(trades, quotes, **options).collect()
    return sorted(((int(r.time.replace(tzinfo=UTC).timestamp() if r.time.tzinfo is None else r.time.timestamp()) - S0, *r[1:]) for r in got), key=lambda r: r[:2])


def account(rows, fill=5):
    """The definition, bucket by bucket, over all events again and again."""
    clock, high = [], -math.inf
    for s, *_ in rows:
        high = max(high, math.floor(s))
        clock.append(high)
    marks = sorted(set(clock))
    emitted, era = [], marks[:1]
    for a, b in zip(marks, marks[1:], strict=False):
        far = b - a > fill + 1
        emitted += [(k, era[-1]) for k in ([a] if far else range(a, b))]
        era.append(b if far else era[-1])
    out, before = [], {}
    for k, e in emitted:
        for sym in sorted({r[1] for r, c in zip(rows, clock, strict=True) if c <= k}):
            own = [(r, c) for r, c in zip(rows, clock, strict=True) if r[1] == sym]
            trades = [r for r, c in own if r[2] == "t" and c == k]
            quotes = [(r[0], (r[3] + r[4]) / 2, (r[4] - r[3]) / ((r[3] + r[4]) / 2) * 1e4, c) for r, c in own if r[2] == "q" and e <= c <= k]
            total = weight = 0.0
            for i, (at, _, spread, c) in enumerate(quotes):
                following = quotes[i + 1] if i + 1 < len(quotes) else None
                if following and following[3] < k:
                    continue
                held = max(0.0, (following[0] if following else k + 1) - max(at, k))
                total, weight = total + held * spread, weight + held
            mid = quotes[-1][1] if quotes else None
            last = before.get((sym, e))
            moved = abs(math.log(mid / last)) * 1e4 if mid is not None and last is not None else None
            before[sym, e] = mid
            out.append((k, sym, len(trades), sum(r[4] for r in trades), sum(r[3] * r[4] for r in trades), total / weight if weight > 1e-9 else None, mid, moved))
    return sorted(out, key=lambda r: r[:2])


def agree(got, want):
    assert [r[:3] for r in got] == [w[:3] for w in want]
    for g, w in zip(got, want, strict=True):
        assert [None if x is None else pytest.approx(x, abs=1e-6) for x in w[3:]] == list(g[3:])


@pytest.mark.parametrize("seed", range(4))
def test_features_against_the_definition(spark, seed):
    rows = events(seed)
    agree(built(spark, rows), account(rows))


def test_pieces_change_nothing(spark, monkeypatch):
    """Rows, clock, buckets and grid are cut into many pieces."""
    rows = events(9, 200)
    whole = built(spark, rows)
    monkeypatch.setattr(running, "PIECE", 23)
    monkeypatch.setattr(features, "BUCKETS", 7)
    monkeypatch.setattr(features, "CELL", 3)
    cut = built(spark, rows)
    agree(cut, whole)


def test_fill_is_bounded(spark):
    """A silence of fill + 1 buckets is filled, one more begins an era."""
    for silence in (3, 4):
        rows = [(0.2, "X", "q", 10, 11), (silence + 0.1, "X", "t", 1, 2.5), (silence + 1.3, "X", "t", 1, 2.5)]
        got = built(spark, rows, max_fill=2)
        assert [r[0] for r in got] == (list(range(silence + 1)) if silence == 3 else [0, silence])
        agree(got, account(rows, fill=2))


def test_no_events_no_features(spark):
    assert built(spark, []) == []
    assert built(spark, [(0.5, "X", "t", 1, 2.5)]) == []  # the open bucket


@pytest.mark.parametrize("seed", range(3))
def test_live_buckets_equal_batch(spark, seed):
    import pickle

    rows, live, want = events(seed + 20), LiveBuckets(), []
    for i, (s, sym, kind, a, b) in enumerate(rows):
        if i == 60:
            live = pickle.loads(pickle.dumps(live))  # as after a restart
        mid = (a + b) / 2
        want += live.feed(S0 * 1_000_000 + round(s * 1e6), sym, (b, a * b) if kind == "t" else None, (mid, (b - a) / mid * 1e4) if kind == "q" else None)
    agree(built(spark, rows), sorted((w[0] // 1_000_000 - S0, *w[1:]) for w in want))


def frames(rows, seed=0):
    """Events as frames, with depth updates, markers, other and broken ones between them."""
    import json

    draw, out, ids = random.Random(seed), [], {}
    for i, (s, sym, kind, a, b) in enumerate(rows):
        at = T0 + timedelta(microseconds=round(s * 1e6))
        ms = int(at.timestamp() * 1000)
        if kind == "t":
            data = {"e": "trade", "E": ms, "s": sym, "t": i, "p": f"{a:.8f}", "q": f"{b:.8f}", "T": ms, "m": bool(i % 2)}
            out.append((at, json.dumps({"stream": f"{sym.lower()}@trade", "data": data})))
        else:
            out.append((at, json.dumps({"stream": f"{sym.lower()}@bookTicker", "data": {"u": i, "s": sym, "b": f"{a:.8f}", "B": "1", "a": f"{b:.8f}", "A": "1"}})))
        if draw.random() < 0.3:
            first = ids.get(sym, 10) + draw.choice([1, 1, 1, 4, -2])
            ids[sym] = first + 3
            out.append((at, json.dumps({"stream": f"{sym.lower()}@depth@100ms", "data": {"e": "depthUpdate", "E": ms, "s": sym, "U": first, "u": first + 3, "b": [], "a": []}})))
        if draw.random() < 0.1:
            out.append((at, draw.choice(["#connected", "{broken", '{"stream":"x@kline","data":{"e":"kline"}}'])))
    return [(i, at, p) for i, (at, p) in enumerate(out)]


RAW = "seq long, received_at timestamp, payload string"


def test_streams_equal_the_replay_and_go_on_after_a_stop(spark, tmp_path):
    """Gaps, features and flags of both detectors, file by file, with a restart from the checkpoint in between."""
    from tideline.plans.replay import Replay, Settings
    from tideline.sources import sinks
    from tideline.streaming import live

    settings = Settings(window=20, min_samples=5, threshold=2.0, train_window=40, refit_every=15, swap_after=4, quantile=0.9, trees=10)
    rows = frames(events(31, 400, steps=(0.1, 0.3, 0.9, 1.1, -0.2, 8.0)))
    source, root = tmp_path / "raw", str(tmp_path / "store")
    cuts = [0, len(rows) // 3, 2 * len(rows) // 3, len(rows)]

    def land(k):
        spark.createDataFrame(rows[cuts[k] : cuts[k + 1]], RAW).coalesce(1).write.mode("append").parquet(str(source))
        for f in source.glob("*.parquet"):
            if f.name not in landed:
                landed.add(f.name)
                os.utime(f, (1_700_000_000 + 10 * k,) * 2)

    def run():
        raw = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(str(source))
        queries = [live.store_stream(raw, root, str(tmp_path / "c1")), live.store_live(raw, root, str(tmp_path / "c2"), settings)]
        for q in queries:
            assert q.awaitTermination(240) and q.exception() is None

    landed = set()
    land(0), land(1)
    run()
    assert sinks.stored(spark, root, "features").count() > 0
    land(2)
    run()
    replay = Replay(spark.createDataFrame(rows, RAW), settings)
    key = lambda r: tuple(map(str, r))
    for name, want in (("trades", replay.trades), ("depth_updates", replay.depth), ("depth_gaps", replay.gaps), ("features", replay.features), ("anomaly_flags", replay.flags())):
        from tideline.schemas import KEYS, conformed

        a, b = (sorted(df.drop("seq").collect(), key=lambda r: key(r[k] for k in KEYS[name])) for df in (sinks.stored(spark, root, name), conformed(sinks.first_wins(want, KEYS[name]) if "seq" in want.columns else want, name)))
        assert [key(r[k] for k in KEYS[name]) for r in a] == [key(r[k] for k in KEYS[name]) for r in b] and len(a) > 0
        for x, y in zip(a, b, strict=True):
            for c in x.asDict():
                if isinstance(x[c], float):
                    assert x[c] == pytest.approx(y[c], abs=1e-6)
                elif isinstance(x[c], dict):
                    assert x[c] == pytest.approx(y[c], abs=1e-6)
                else:
                    assert x[c] == y[c]
    assert {r.detector for r in sinks.stored(spark, root, "anomaly_flags").collect()} == {"zscore", "iforest"}


def test_windows_and_first_rows_of_a_stream(spark, tmp_path):
    from tideline.functions import decode
    from tideline.streaming import live

    rows = frames(events(5, 60, steps=(0.5, 1.0)))
    spark.createDataFrame(rows + rows[:20], RAW).coalesce(1).write.parquet(str(tmp_path / "raw"))
    raw = spark.readStream.schema(RAW).parquet(str(tmp_path / "raw"))
    progress = live.Progress(every=0.0, write=lambda line: lines.append(line))
    lines = []
    spark.streams.addListener(progress)
    queries = [
        live.windowed_counts(raw, 10, "0 seconds", slide=5).writeStream.format("memory").queryName("counts").outputMode("append").start(),
        live.first_in_window(decode.trades(decode.typed(decode.decoded(raw))), ["symbol", "trade_id"], "1 hour").writeStream.format("memory").queryName("first").start(),
        live.feature_stream(raw).writeStream.format("memory").queryName("buckets").start(),
    ]
    live.drained(*queries)
    once = [p for _, _, p in rows if '"trade"' in p]
    assert spark.table("first").count() == len(once)
    assert spark.table("buckets").count() > 0
    total = {(r.window.start, r.status): r.n for r in spark.table("counts").collect()}
    for (start, status), n in total.items():
        if status == "trade":
            begin = start.replace(tzinfo=UTC) if start.tzinfo is None else start
            assert n == sum(begin <= at < begin + timedelta(seconds=10) and '"trade"' in p for _, at, p in rows + rows[:20])
    assert total
    for _ in range(50):
        if progress.rows:
            break
        time.sleep(0.2)
    spark.streams.removeListener(progress)
    assert progress.rows > 0 and "rows/s" in lines[0]
