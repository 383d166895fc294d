"""As-of joins and sessions against plain loops, in one piece and in many, in batch and in a stream."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.functions import running
from tideline.operators.asof import asof_join
from tideline.operators.sessions import session_stream, sessions
from tideline.streaming import live

T0 = datetime(2025, 7, 8, 9, tzinfo=UTC)


def drawn(seed, n):
    draw = random.Random(seed)
    return [(draw.choice(["A", "B", None]), draw.choice([None, *range(40)]), i, draw.choice([None, draw.randint(0, 9)])) for i in range(n)]


@pytest.mark.parametrize("strict,tolerance,piece", [(False, None, 500_000), (True, None, 11), (False, 3, 11), (True, 0, 500_000)])
def test_asof(spark, monkeypatch, strict, tolerance, piece):
    monkeypatch.setattr(running, "PIECE", piece)
    a, b = drawn(1, 80), drawn(2, 60)
    left = spark.createDataFrame(a + a[:5], "k string, t bigint, seq bigint, v int")
    right = spark.createDataFrame(b, "k string, t bigint, seq bigint, w int").withColumn("extra", F.lit("x"))
    got = [tuple(r) for r in asof_join(left, right, ["k"], "t", ["w", "extra"], tie="seq", strict=strict, tolerance=tolerance).select("k", "t", "seq", "v", "w", "extra").collect()]
    want = []
    for k, t, seq, v in a + a[:5]:
        best = None
        if k is not None and t is not None:
            ahead = [r for r in b if r[0] == k and r[1] is not None and ((r[1], r[2]) < (t, seq) or (not strict and (r[1], r[2]) == (t, seq)))]
            best = max(ahead, key=lambda r: (r[1], r[2]), default=None)
            best = best if best and (tolerance is None or t - best[1] <= tolerance) else None
        want.append((k, t, seq, v, best[3] if best else None, "x" if best else None))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_asof_without_ties_or_rows(spark):
    left = spark.createDataFrame([("A", T0 + timedelta(seconds=5))], "k string, t timestamp")
    right = spark.createDataFrame([("A", T0, 1), ("A", T0 + timedelta(seconds=4), 2), ("A", T0 + timedelta(seconds=6), 3)], "k string, t timestamp, w int")
    assert asof_join(left, right, ["k"], "t", ["w"]).first().w == 2
    assert asof_join(left, right, ["k"], "t", ["w"], tolerance=900_000).first().w is None
    assert asof_join(left, right.where("w > 9"), ["k"], "t", ["w"]).first().w is None
    assert asof_join(left.where("false"), right, ["k"], "t", ["w"]).collect() == []


def walked(seed):
    draw, rows = random.Random(seed), []
    for k in "AB":
        at = 0
        for _ in range(60):
            at += draw.choice([0, 1, 2, 4, 5, 9])
            rows.append((k, at))
    return rows


def split(rows, gap):
    out = []
    for k in sorted({r[0] for r in rows}):
        run = []
        for t in sorted(t for s, t in rows if s == k):
            if run and t - run[-1] > gap[k]:
                out.append((k, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        out.append((k, run[0], run[-1], len(run)))
    return sorted(out)


def seconds(rows):
    return sorted((r.k, *(int((t.replace(tzinfo=UTC) - T0).total_seconds()) for t in (r.began, r.ended)), r.n_rows) for r in rows)


@pytest.mark.parametrize("piece", [7, 500_000])
def test_sessions(spark, monkeypatch, piece):
    monkeypatch.setattr(running, "PIECE", piece)
    rows = walked(piece)
    df = spark.createDataFrame([(k, T0 + timedelta(seconds=t)) for k, t in rows] + [("A", None)], "k string, t timestamp")
    gap = F.when(F.col("k") == "A", 4).otherwise(5)
    assert seconds(sessions(df, ["k"], "t", gap).collect()) == split(rows, {"A": 4, "B": 5})
    assert sessions(df.where("false"), ["k"], "t", gap).collect() == []


def streamed(spark, tmp_path, df, make):
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = make(source)
    out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect()


def test_sessions_of_a_stream_equal_those_of_a_batch(spark, tmp_path):
    """All sessions that the watermark has passed; a late row of another key moves it."""
    rows = walked(3)
    df = spark.createDataFrame([(k, T0 + timedelta(seconds=t)) for k, t in rows] + [("Z", T0 + timedelta(seconds=9000))], "k string, t timestamp")
    gap = F.when(F.col("k") == "A", 4).otherwise(5)
    got = streamed(spark, tmp_path, df, lambda source: session_stream(source(), ["k"], "t", gap, "10 seconds"))
    assert [r for r in seconds(got) if r[0] != "Z"] == split(rows, {"A": 4, "B": 5})


def test_near_flags_of_two_streams(spark, tmp_path):
    draw = random.Random(8)
    rows = [(draw.choice("AB"), T0 + timedelta(milliseconds=700 * i), draw.random() < 0.3, draw.random() < 0.2) for i in range(150)]
    df = spark.createDataFrame(rows, "symbol string, time timestamp, a boolean, b boolean")
    got = streamed(spark, tmp_path, df, lambda source: live.near_stream(source().where("a and not b").select("symbol", "time"), source().where("b").select("symbol", "time"), 2, "1 hour"))
    want = [(s, t) for s, t, a, b in rows if a and not b and any(b2 and s2 == s and abs(t2 - t) <= timedelta(seconds=2) for s2, t2, _, b2 in rows)]
    assert sorted((r.symbol, r.time.replace(tzinfo=UTC)) for r in got) == sorted(want)
