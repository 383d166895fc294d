"""Sinks, metrics, backoff and the registry."""

import os
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tideline.operators import dashboard, metrics
from tideline.plans import registry
from tideline.sources import shared, sinks

TRADES = "seq long, time timestamp, symbol string, trade_id long, price double"
T0 = datetime(2031, 3, 14, 7, tzinfo=UTC)


def test_merge_keeps_the_first_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "trades")
    one = spark.createDataFrame([(2, T0, "B", 1, 9.0), (1, T0, "B", 1, 5.0), (3, T0, "B", 2, 6.0)], TRADES)
    two = spark.createDataFrame([(4, T0, "B", 2, 7.0), (5, T0, "E", 1, 8.0)], TRADES)
    for df in (one, two, two, one):
        sinks.merge(df, path, "trades", partition="time")
    got = spark.read.parquet(path).orderBy("symbol", "trade_id")
    assert [(r.symbol, r.trade_id, r.price) for r in got.collect()] == [("B", 1, 5.0), ("B", 2, 6.0), ("E", 1, 8.0)]
    before = sinks.ordered_hash(got, ["symbol", "trade_id"])
    sinks.merge(two, path, "trades", partition="time")
    assert sinks.ordered_hash(spark.read.parquet(path), ["symbol", "trade_id"]) == before


def test_merge_takes_null_keys_once(spark, tmp_path):
    path = str(tmp_path / "trades")
    rows = spark.createDataFrame([(1, T0, None, 1, 5.0), (2, None, "B", 1, 6.0), (3, None, None, None, 7.0), (4, T0, "B", None, 8.0)], TRADES)
    assert [sinks.merge(rows, path, "trades", partition="time") for _ in range(3)] == [4, 0, 0]
    more = spark.createDataFrame([(5, None, "B", 1, 9.0), (6, None, "C", 1, 9.0)], TRADES)
    assert sinks.merge(more, path, "trades", partition="time") == 1


def test_a_batch_reads_what_can_hold_its_keys(spark, tmp_path):
    """Of a day, a batch that goes on where it ends reads the files' footers only: a small part of what the rows take."""
    path, took = str(tmp_path / "trades"), []
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem

    def read():
        return sum(s.getBytesRead() for s in stats.getAllStatistics() if s.getScheme() == "file")

    def batch(k):
        ids = spark.range(k * 20_000, (k + 1) * 20_000, 1, 2)
        return ids.selectExpr("id as seq", f"timestamp_millis({int(T0.timestamp() * 1000)} + id) as time", "concat('S', id % 3) as symbol", "id as trade_id", "rand(1) as price")

    for k in range(12):
        before = read()
        assert sinks.merge(batch(k), path, "trades", partition="time") == 20_000
        took.append(read() - before)
    assert sinks.merge(batch(5), path, "trades", partition="time") == 0
    stored = sum(f.stat().st_size for f in (tmp_path / "trades").rglob("*.parquet"))
    assert (took[11] - took[1]) / 10 < 0.05 * stored / 12
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = sinks.overlapping(spark.read.parquet(path), batch(3).withColumn("date", F.to_date("time")), ["symbol", "trade_id", "time"])._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(trade_id,60000)" in plan and "PartitionFilters: [isnotnull(date" in plan


def test_content_hash_ignores_order(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(2, "x"), (1, None)], "a int, b string")
    c = spark.createDataFrame([(2, "x"), (1, "")], "a int, b string")
    assert sinks.content_hash(a).first() == sinks.content_hash(b).first() != sinks.content_hash(c).first()


def test_counters_and_histograms(spark):
    rows = spark.createDataFrame([("a", 0, 5), ("a", 10, 8), ("a", 20, 2), ("a", 90, 4)], "s string, ts long, value long")
    got = metrics.increase(rows, ["s"], 60).orderBy("ts").collect()
    assert [r.increase for r in got] == [0, 3, 5, 2]
    values = spark.createDataFrame([(float(x),) for x in range(1, 101)], "value double")
    h = metrics.histogram(values, [25, 50, 100], [])
    assert sorted((r.le, r.n) for r in h.collect()) == [(25.0, 25), (50.0, 50), (100.0, 100), (float("inf"), 100)]
    assert metrics.histogram_quantile(h, 0.75, []).first()["quantile"] == pytest.approx(75.0)


def test_quantiles_of_rates(spark):
    """Bucket counters of two instances with a restart, against plain steps."""
    draw, rows, want = random.Random(1), [], {}
    for instance in "ab":
        totals = dict.fromkeys((1.0, 2.0, float("inf")), 0)
        for ts in range(0, 300, 10):
            if instance == "b" and ts == 150:
                totals = dict.fromkeys(totals, 0)
            low, middle, high = (draw.randint(0, 3) for _ in range(3))
            for le, n in zip(totals, (low, low + middle, low + middle + high), strict=True):
                totals[le] += n
                rows.append((instance, le, ts, totals[le]))
                if ts and 200 < ts <= 260:
                    want[le] = want.get(le, 0) + n
    df = spark.createDataFrame(rows, "instance string, le double, ts long, value long")
    got = metrics.quantile_of_rates(df, 0.5, [], ["instance"], [260], 60).collect()
    rank = 0.5 * want[float("inf")]
    expected = rank / want[1.0] if want[1.0] >= rank else 1 + (rank - want[1.0]) / (want[2.0] - want[1.0]) if want[2.0] >= rank else 2.0
    assert len(got) == 1 and got[0]["quantile"] == pytest.approx(expected)


@pytest.mark.parametrize("piece", (500_000, 40))
def test_bucket_counters_run_over_pieces(spark, monkeypatch, piece):
    """Counters of two kinds (one of them null) in one piece and in many, against plain sums."""
    from tideline.functions import running

    monkeypatch.setattr(running, "PIECE", piece)
    draw, bounds = random.Random(2), [1.0, 2.0]
    rows = [(draw.choice(("a", None)), draw.randint(0, 150), draw.choice((0.5, 1.0, 1.5, 3.0, None))) for _ in range(600)]
    df = spark.createDataFrame(rows, "k string, ts long, value double").selectExpr("struct(k) as kind", "ts", "value")
    got = {(r.kind.k, r.ts, r.le): r.value for r in metrics.bucket_counters(df, bounds, ["kind"]).collect()}
    want = {(k, ts, le): sum(1 for a, t, v in rows if a == k and t <= ts and v is not None and v <= le) for k, ts, _ in rows for le in (*bounds, float("inf"))}
    assert got == want


def test_metrics_of_a_replay(spark):
    frames = spark.createDataFrame([("trade", T0), ("trade", T0), ("quote", T0), ("error", T0), ("other", T0), ("marker", T0)], "status string, received_at timestamp")
    gaps = spark.createDataFrame([("A", "stream"), ("A", "stream"), ("B", "reconnect")], "symbol string, cause string")
    flags = spark.createDataFrame([("A", "zscore")], "symbol string, detector string")
    got = {(r.name, tuple(sorted(r.labels.items()))): r.value for r in metrics.of_replay(frames, gaps, flags).collect()}
    assert got[("frames_total", (("stream", "trade"),))] == 2 and got[("frames_total", (("stream", "other"),))] == 2 and got[("frames_total", (("stream", "bookticker"),))] == 1
    assert got[("parse_errors_total", ())] == 1 and got[("depth_gaps_total", (("cause", "stream"), ("symbol", "A")))] == 2 and got[("anomaly_flags_total", (("detector", "zscore"), ("symbol", "A")))] == 1
    assert {n for n, _ in got} <= set(metrics.COUNTERS) | set(metrics.GAUGES)


def test_time_clip_and_appends(spark, tmp_path):
    rows = spark.createDataFrame([(T0.replace(minute=m), m) for m in range(5)], "time timestamp, n int")
    assert sorted(r.n for r in dashboard.between(rows, "2031-03-14 07:01:00", "2031-03-14 07:03:00").collect()) == [1, 2, 3]
    assert dashboard.between(rows, None, None).count() == 5
    assert sinks.append(rows, str(tmp_path / "t")) == 5 == sinks.append(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10
    stats = sinks.table_stats(spark, str(tmp_path / "t")).first()
    assert (stats.n_rows, stats.n_days) == (10, 0) and stats.n_bytes > 0 and stats.n_files >= 2
    plan, seconds = sinks.explained(rows.where("n > 1"))
    assert "Filter" in plan and seconds > 0


def test_shared_folder(spark, tmp_path):
    df = shared.settled(spark.range(5).toDF("a"), "x")
    path = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert df.count() == 5 and os.path.isdir(path)
    shared.dropped(df)
    assert not os.path.isdir(path)
    other = shared.settled(spark.range(3).toDF("a"), "x").inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    made, shared._made[:] = list(shared._made), [f"file://{other}"]
    shared.cleaned(spark)
    shared._made[:] = made
    assert not os.path.isdir(other)


def test_registry():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert len(registry.queries()) >= 45
