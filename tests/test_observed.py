"""What the engine counts of itself: text format, series observed in micro-batches, and the operators on series over them."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tideline.functions.decode import decoded
from tideline.operators import metrics
from tideline.sources import metrics_text
from tideline.streaming import live, observed


def test_text_and_back(spark):
    rows = [
        ("a_total", {"x": 'quote " back \\ end\nnext', "b": "1"}, 3.0), ("a_total", {"x": "\\n is no line end", "b": ""}, 0.25), ("b", {}, float("inf")),
        ("c_bucket", {"le": "+Inf"}, 7.0), ("d", {"x": "a,b=\"c\"}"}, -1e-9), ("e", {}, 1.7e18),
    ]
    lines = metrics_text.written(spark.createDataFrame(rows, metrics_text.SAMPLES))
    assert all("\n" not in r.value for r in lines.collect())
    got = {(r["name"], tuple(sorted(r.labels.items()))): r["value"] for r in metrics_text.read(lines).collect()}
    assert got == {(n, tuple(sorted(m.items()))): v for n, m, v in rows}


def test_lines_that_tell_nothing(spark):
    texts = ["# HELP a it", "# TYPE a counter", "", None, "a", "a b c", 'a{x="1" 2', "up_now 3", "up 1.5 1700000000000", 'up{} 4', "NaN_metric NaN"]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [(r["name"], r["value"]) for r in metrics_text.read(lines).where("not isnan(value)").collect()] == [("up_now", 3.0), ("up", 1.5), ("up", 4.0)]
    assert metrics_text.value_of(lines.where("value like 'up %'"), "up") == 1.5 and metrics_text.value_of(lines, "up_n") is None
    assert metrics_text.read(lines.limit(0)).count() == 0


def test_series_know_their_names_and_labels():
    series = observed.Series(clock=lambda: 5.0)
    series.add("frames_total", 2, stream="trade")
    series.add("frames_total", stream="trade")
    for wrong in (lambda: series.add("frames_total", 1), lambda: series.add("no_total"), lambda: series.put("frames_total", 1.0)):
        with pytest.raises((KeyError, ValueError)):
            wrong()
    series.saw("flush_seconds", 0.3)
    series.snapshot()
    got = {(n, tuple(sorted(m.items()))): v for _, n, m, v in series.pending}
    assert got["frames_total", (("stream", "trade"),)] == 3 and got["flush_seconds_count", ()] == 1
    assert got["flush_seconds_bucket", (("le", "0.25"),)] == 0 and got["flush_seconds_bucket", (("le", "0.5"),)] == got["flush_seconds_bucket", (("le", "+Inf"),)] == 1


def _frames(draw, begin, n):
    out = []
    for i in range(begin, begin + n):
        at, kind = datetime.fromtimestamp(1_790_000_000 + i // 4, UTC), draw.choice(["trade", "depth", "quote", "bad", "other", "#connected"])
        ms = 1_790_000_000_000 + 250 * i
        payload = {
            "trade": f'{{"stream":"s@trade","data":{{"e":"trade","E":{ms},"s":"S","t":{i},"p":"2.5","q":"1","T":{ms},"m":true}}}}',
            "depth": f'{{"stream":"s@depth","data":{{"e":"depthUpdate","E":{ms},"s":"S","U":{3 * i},"u":{3 * i + 1},"b":[],"a":[]}}}}',
            "quote": f'{{"stream":"s@bookTicker","data":{{"u":{i},"s":"S","b":"2.4","B":"1","a":"2.6","A":"1"}}}}',
            "other": '{"stream":"s@kline","data":{"e":"kline"}}', "bad": "{", "#connected": "#connected",
        }[kind]
        out.append((i, at, payload))
    return out


def test_a_stream_observes_itself(spark, tmp_path):
    """Three batches, then a new process: counters begin again, and increases over both are those of the frames."""
    import random

    draw, schema = random.Random(3), "seq bigint, received_at timestamp, payload string"
    rows, root, store = _frames(draw, 0, 240), tmp_path / "in", str(tmp_path / "samples")
    for run in range(2):
        series = observed.Series(clock=iter(range(1000 * run, 1000 * run + 1000)).__next__)
        listener = observed.Observer(series)
        spark.streams.addListener(listener)
        try:
            for batch in range(3):
                part = rows[120 * run + 40 * batch : 120 * run + 40 * (batch + 1)]
                spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(root))
                frames = observed.observed(decoded(spark.readStream.schema(schema).parquet(str(root))))
                query = frames.select("status").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
                query.awaitTermination()
                assert listener.ended.wait(30)
        finally:
            spark.streams.removeListener(listener)
        series.store(spark, store)
        assert series.store(spark, store) == 0
    status = {r["status"]: r["n"] for r in decoded(spark.createDataFrame(rows, schema)).groupBy("status").agg(F.count("*").alias("n")).collect()}
    samples = observed.stored_samples(spark, store).withColumn("ts", F.col("ts").cast("bigint"))
    trades = observed.labelled(samples.where("name = 'frames_total'"), "stream")
    first = {r["stream"]: r["value"] for r in trades.where("ts = 0").collect()}
    risen = {r["stream"]: r["increase"] for r in metrics.increase(trades, ["stream"], 5000).where("ts = 1002").collect()}
    own = {"trade": status["trade"], "depth": status["depth"], "bookticker": status["quote"], "other": status["other"] + status["error"]}
    assert {k: risen[k] + first[k] for k in own} == own
    last = observed.latest(samples)
    lines = metrics_text.written(last)
    assert metrics_text.value_of(lines, "last_frame_timestamp_seconds") == max(r[1].timestamp() for r in rows if not r[2].startswith("#"))
    health = metrics.staleness(last.where("name = 'last_frame_timestamp_seconds'").select(F.timestamp_seconds("value").alias("t")), F.timestamp_seconds(F.lit(1_790_000_100)), [], "t")
    assert health.first().health == "healthy"


def test_a_sink_counts_and_times_its_batches(spark, tmp_path):
    import random

    schema, root, series = "seq bigint, received_at timestamp, payload string", str(tmp_path / "in"), observed.Series(clock=lambda: 9.0)
    rows = _frames(random.Random(4), 0, 400)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(root)
    live.store_live(spark.readStream.schema(schema).parquet(root), str(tmp_path / "store"), str(tmp_path / "state"), series=series).awaitTermination()
    gaps = spark.read.parquet(str(tmp_path / "store/depth_gaps")).groupBy("symbol", "cause").agg(F.count("*").alias("n")).collect()
    got = {(r["name"], tuple(sorted(r.labels.items()))): r["value"] for r in series.samples(spark).collect()}
    assert gaps and {(r.symbol, r.cause): r.n for r in gaps} == {(dict(k)["symbol"], dict(k)["cause"]): v for (n, k), v in got.items() if n == "depth_gaps_total"}
    assert got["flush_seconds_count", ()] == 3
    buckets = observed.labelled(series.samples(spark).where("name = 'flush_seconds_bucket'"), "le").select(F.when(F.col("le") == "+Inf", float("inf")).otherwise(F.col("le").try_cast("double")).alias("le"), F.col("value").alias("n"))
    assert metrics.histogram_quantile(buckets, 0.5, []).first()["quantile"] > 0
