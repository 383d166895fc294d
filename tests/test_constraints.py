"""Constraints of the stored tables, their set-up, and what the command line says of metrics and writes."""

import json
import time
from datetime import UTC, datetime

import pytest

from tideline import cli, schemas
from tideline.sources import metrics_text, sinks

T0 = datetime(2031, 3, 14, 7, tzinfo=UTC)
GAPS = "seq bigint, time timestamp, symbol string, prev_final_update_id bigint, first_update_id bigint, missing_update_ids bigint, cause string, received_at timestamp"


def _gap(i, symbol="A", cause="stream", at=T0):
    return i, at, symbol, 10 * i, 10 * i + 5, 4, cause, at


def test_a_strict_merge_stores_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "depth_gaps")
    good = spark.createDataFrame([_gap(i) for i in range(5)], GAPS)
    assert sinks.merge(good, path, "depth_gaps", strict=True) == 5
    for bad in (_gap(9, symbol=None), _gap(9, cause="other"), _gap(9, at=None)):
        with pytest.raises(Exception, match="depth_gaps: "):
            sinks.merge(spark.createDataFrame([_gap(8), bad], GAPS), path, "depth_gaps", strict=True)
        assert spark.read.parquet(path).count() == 5
    assert sinks.merge(spark.createDataFrame([_gap(8), _gap(9, cause=None)], GAPS), path, "depth_gaps") == 2


def test_what_rows_break(spark):
    rows = spark.createDataFrame([_gap(1), _gap(2, None, "other"), _gap(3, cause=None)], GAPS)
    assert {r.seq: r.broken for r in sinks.rejected(rows, "depth_gaps").collect()} == {2: ["symbol is null", "cause has another value"], 3: ["cause is null"]}
    features = spark.createDataFrame([(T0, "A", 1, 1.0, 1.0, None, None, None), (T0, "A", None, 1.0, 1.0, 1.0, 1.0, 1.0)], schemas.TABLES["features"])
    assert [r.broken for r in sinks.rejected(features, "features").collect()] == [["trade_count is null"]]
    assert sinks.rejected(features.limit(0), "features").count() == 0


def test_set_up_of_a_store(spark, tmp_path):
    root = str(tmp_path / "store")
    assert sinks.set_up(spark, root) == list(schemas.TABLES) and sinks.set_up(spark, root) == []
    for table in schemas.TABLES:
        assert sinks.stored(spark, root, table).count() == 0
    assert sinks.merge(spark.createDataFrame([_gap(1)], GAPS), f"{root}/depth_gaps", "depth_gaps") == 1
    assert sinks.set_up(spark, root) == [] and sinks.stored(spark, root, "depth_gaps").count() == 1


def test_commands(spark, tmp_path, capsys):
    for age, code in ((0, 0), (500, 1)):
        path = str(tmp_path / f"m{age}")
        metrics_text.written(spark.createDataFrame([("last_frame_timestamp_seconds", {}, time.time() - age)], metrics_text.SAMPLES)).write.text(path)
        assert cli.main(["health", "--metrics", path]) == code
    assert cli.main(["setup", "--store", str(tmp_path / "s")]) == 0
    capsys.readouterr()
    assert cli.main(["writebench", "--store", str(tmp_path / "w"), "--rows", "500"]) == 0
    got = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [(r["way"], r["rows"]) for r in got] == [("append", 500), ("merge", 500), ("merge again", 0)]
    with pytest.raises(SystemExit):
        cli.main(["health"])
