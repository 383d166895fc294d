"""The driver's stream queries in several batches of bounded size."""

import time

import pytest

from tideline.plans import registry
from tideline.streaming import live

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def batches(spark, monkeypatch):
    """Files of about 150 frames, two in a batch; gives the numbers of rows of the batches so far."""
    monkeypatch.setattr(live, "FRAMES", 150, raising=False)
    monkeypatch.setattr(live, "FILES", 2, raising=False)
    progress, sizes = live.Progress(), []
    progress.add = sizes.append
    spark.streams.addListener(progress)
    yield sizes
    spark.streams.removeListener(progress)


def _came(sizes):
    for _ in range(50):
        if sum(sizes) >= 1000:
            break
        time.sleep(0.2)
    return [n for n in sizes if n]


def _same(spark, streamed, replayed):
    got, want = (registry.queries()[q](spark, SMALL) for q in (streamed, replayed))
    want = want.select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and not got.isEmpty()


def test_gaps_come_of_bounded_batches_in_order(spark, batches):
    _same(spark, "stream_gaps", "gap_detect")
    sizes = _came(batches)
    assert sum(sizes) == 1000 and len(sizes) > 2 and max(sizes) < 600


def test_ordered_stream_gives_files_in_order(spark, tmp_path):
    raw = spark.range(1000).selectExpr("struct(-id as a, id as b) as seq", "current_timestamp() as received_at", "string(id) as payload").repartition(7)
    stream, seen = live.ordered_stream(raw, str(tmp_path / "frames"), 100, 1), []
    stream.writeStream.foreachBatch(lambda df, _: seen.append([r.seq.a for r in df.collect()])).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) > 5 and [a for batch in seen for a in batch] == sorted(-i for i in range(1000))


def test_ids_stay_exact(spark, tmp_path):
    """Update ids beyond 2 ** 53, beside frames that have none."""
    big = 2**53 + 1
    frame = lambda s, u, v: f'{{"stream":"x@depth","data":{{"e":"depthUpdate","E":1,"s":"{s}","U":{u},"u":{v},"b":[],"a":[]}}}}'
    payloads = [frame("A", big - 2, big), frame("A", big + 2, big + 4), '{"stream":"a@bookTicker","data":{"u":1,"s":"A","b":"1","B":"1","a":"2","A":"1"}}']
    raw = spark.createDataFrame(list(enumerate(payloads)), "seq long, payload string").selectExpr("seq", "timestamp_seconds(seq) as received_at", "payload")
    rows = live.live_rows(live.ordered_stream(raw, str(tmp_path / "frames")))
    rows.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = live.gaps_of(spark.read.schema(rows.schema).parquet(str(tmp_path / "rows"))).collect()
    assert [(r.prev_final_update_id, r.first_update_id, r.missing_update_ids) for r in got] == [(big, big + 2, 1)]


def test_features_come_of_bounded_batches_without_scores(spark, batches):
    _same(spark, "stream_features", "features")
    sizes = _came(batches)
    assert sum(sizes) == 1000 and len(sizes) > 2 and max(sizes) < 600
    feature = dict.fromkeys(live.FEATURES, 1.0)
    assert [row["kind"] for row in live._scored(feature, live.LiveScores(live.Settings(), ("feature",)), ("feature",))] == ["feature"]


def test_zscores_keep_their_window_and_fit_no_forest(spark, batches):
    _same(spark, "stream_zscores", "zscore_flags")
    sizes = _came(batches)
    assert sum(sizes) == 1000 and len(sizes) > 2 and max(sizes) < 600


def test_a_stream_of_zscores_keeps_the_rows_of_its_window():
    import numpy as np

    settings = live.Settings(window=20, min_samples=5, train_window=60, refit_every=30, swap_after=5, trees=5)
    own, both, draw = live.LiveScores(settings, ("zscore",)), live.LiveScores(settings), np.random.default_rng(1)
    for x in draw.exponential(size=(200, 4)):
        assert [f for f in both.feed("A", x) if f[0] == "zscore"] == list(own.feed("A", x))
    assert len(own.rows["A"]) == 20 and not own.forests and both.forests
