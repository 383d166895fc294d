"""Reads of a time range open the files of its hours only, and give what a filtered read of all gives."""

from datetime import UTC, datetime, timedelta

import pytest

from tideline.sources.archive import read_archive, write_archive

T = datetime(2025, 5, 30, 21, tzinfo=UTC)


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    """Two batches over 60 hours, four frames an hour, and a file without an hour's name."""
    root = tmp_path_factory.mktemp("archive")
    for first in (0, 1):
        frames = [(i, T + timedelta(minutes=30 * i + 7 * first, microseconds=i), f"b{first} f{i}") for i in range(120)]
        write_archive(spark.createDataFrame(frames, "seq bigint, received_at timestamp, payload string"), str(root), compressed=first == 0)
    (root / "loose.tsv").write_text(f"{int((T + timedelta(hours=5)).timestamp() * 1e9)}\tloose\n{int((T + timedelta(days=9)).timestamp() * 1e9)}\tlate\n")
    return str(root)


def listed(df):
    return [tuple(r) for r in df.orderBy("seq").select("received_at", "received_ns", "payload").collect()]


@pytest.mark.parametrize(
    "since,until,hours",
    [
        (T + timedelta(hours=3), T + timedelta(hours=27), 24),  # a day, whole
        (T + timedelta(hours=4, minutes=40), T + timedelta(hours=6, minutes=10), 3),  # within hours
        (None, T + timedelta(hours=1), 1),
        (T + timedelta(hours=58), None, 2),
        (T - timedelta(days=40), T - timedelta(days=39), 0),
        (T + timedelta(hours=2), T + timedelta(hours=2), 0),
    ],
)
def test_range(spark, archive, since, until, hours):
    whole = read_archive(spark, archive)
    want = whole
    if since is not None:
        want = want.where(want.received_at >= since)
    if until is not None:
        want = want.where(want.received_at < until)
    got = read_archive(spark, archive, since=since, until=until)
    assert listed(got) == listed(want)
    # of both batches, and the loose one
    assert len(got.inputFiles()) <= 2 * hours + 1 < len(whole.inputFiles())


def test_days_out_of_range_are_not_in_the_plan(spark, archive):
    got = read_archive(spark, archive, since=datetime(2025, 5, 31), until=datetime(2025, 6, 1))  # without a zone: UTC
    names = {f.split("/")[-2] for f in got.inputFiles() if "loose" not in f}
    assert names == {"2025-05-31"} and "/2025-06-01" not in got._jdf.queryExecution().toString()


def test_nothing_named(spark, tmp_path):
    assert read_archive(spark, str(tmp_path), since=datetime(2025, 1, 1)).collect() == []


def test_hours_of_paths(spark):
    """As the plain pattern says, and in time that doesn't grow with the square of a part's length."""
    import re
    import time

    from tideline.sources.archive import _hour_of

    paths = ["file:/a/b/2025-05-30/21.tsv.gz", "file:/a/loose.tsv", "s3://x/y.z/07.tsv", "/a//b.tsv", "/a/.tsv", "/a/b", "x.tsv"]
    found = [re.search(r"([^/]+/[^/.]+)[^/]*$", p) for p in paths]
    got = spark.createDataFrame([(p,) for p in paths], "path string").select(_hour_of("path").alias("hour")).collect()
    assert [r.hour for r in got] == [m[1] if m else "" for m in found]
    began = time.perf_counter()
    long = spark.range(100_000).selectExpr("concat(repeat('/' || repeat('a', 200), 5), '/b', id, '/07.tsv.gz') as path")
    assert long.where(_hour_of("path") == long.path.substr(1007, 99)).count() == 0 and time.perf_counter() - began < 20
