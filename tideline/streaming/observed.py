"""What a running engine counts of itself: metrics observed in each micro-batch, kept as series, stored as samples.

Frames are counted by observe() in the plan of the stream, so a batch is not read again for it; the listener takes the
numbers from the batch's progress. Gaps and flags are counted by label in the sink of their stream, a row per symbol and
label. The driver holds the series' last values, and the snapshots since they were last stored: one for each batch.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tideline.operators.metrics import COUNTERS, GAUGES, HISTOGRAMS, stream_of

#: Samples as they are stored: series are told apart by name and labels.
STORED = "ts double, name string, labels map<string,string>, value double"


class Series:
    """Counters, gauges and histograms by name and labels. Counters begin at zero when a process begins."""

    def __init__(self, clock=time.time):
        self.clock, self.lock = clock, threading.Lock()
        self.values: dict[tuple, float] = {}
        self.pending: list[tuple] = []

    def add(self, name: str, n: float = 1, **labels: str) -> None:
        if set(labels) != set(COUNTERS[name]):
            raise ValueError(f"{name} has the labels {COUNTERS[name]}")
        self._put(name, labels, n, add=True)

    def put(self, name: str, value: float) -> None:
        if name not in GAUGES:
            raise ValueError(f"no gauge {name}")
        self._put(name, {}, value, add=False)

    def saw(self, name: str, value: float, **labels: str) -> None:
        """A value of a histogram."""
        for bound in (*HISTOGRAMS[name][1], float("inf")):
            self._put(f"{name}_bucket", labels | {"le": "+Inf" if bound == float("inf") else str(bound)}, float(value <= bound), add=True)
        self._put(f"{name}_sum", labels, value, add=True)
        self._put(f"{name}_count", labels, 1, add=True)

    def _put(self, name: str, labels: dict, value: float, *, add: bool) -> None:
        key = name, tuple(sorted(labels.items()))
        with self.lock:
            self.values[key] = value + (self.values.get(key, 0.0) if add else 0.0)

    @contextmanager
    def timed(self, name: str, **labels: str) -> Iterator[None]:
        began = time.perf_counter()
        yield
        self.saw(name, time.perf_counter() - began, **labels)

    def snapshot(self, ts: float | None = None) -> None:
        """Note all values as samples of now, to be stored."""
        with self.lock:
            now = float(self.clock() if ts is None else ts)
            self.pending += [(now, name, dict(labels), float(v)) for (name, labels), v in self.values.items()]

    def samples(self, spark: SparkSession) -> DataFrame:
        """name, labels and value as they are now."""
        with self.lock:
            rows = [(name, dict(labels), float(v)) for (name, labels), v in self.values.items()]
        return spark.createDataFrame(rows, "name string, labels map<string,string>, value double")

    def store(self, spark: SparkSession, path: str) -> int:
        """Append the samples noted since the last call to the table at path, and say how many they were."""
        with self.lock:
            rows, self.pending = self.pending, []
        if rows:
            spark.createDataFrame(rows, STORED).withColumn("date", F.to_date(F.timestamp_seconds("ts"))).coalesce(1).write.mode("append").partitionBy("date").parquet(path)
        return len(rows)


def stored_samples(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """Stored samples; of those since a time, only its days are read."""
    rows = spark.read.schema(f"{STORED}, date date").parquet(path)
    if since is not None:
        rows = rows.where((F.col("date") >= F.lit(since.astimezone(UTC).date())) & (F.col("ts") >= since.timestamp()))
    return rows.drop("date")


def labelled(samples: DataFrame, *labels: str) -> DataFrame:
    """samples with these labels as columns in place of the map, as operators on series take them."""
    return samples.select(*(c for c in samples.columns if c != "labels"), *(F.col("labels")[x].alias(x) for x in labels))


def latest(samples: DataFrame) -> DataFrame:
    """name, labels and value of each series' last sample."""
    entries = F.array_sort(F.map_entries("labels"))
    return samples.groupBy("name", entries.alias("__e")).agg(F.max_by("value", "ts").alias("value")).select("name", F.map_from_entries("__e").alias("labels"), "value")


#: Names of the streams that frames are counted by; fixed values.
STREAMS = ("trade", "depth", "bookticker", "other")


def observed(frames: DataFrame, name: str = "frames") -> DataFrame:
    """decoded() frames whose numbers each batch's progress tells, and the listener takes."""
    status, own = F.col("status"), ~F.col("status").isin("marker", "comment")
    stream = stream_of(status)
    return frames.observe(
        name, *(F.count_if(own & (stream == s)).alias(s) for s in STREAMS), F.count_if(status == "error").alias("errors"), F.count_if(status.isin("trade", "depth")).alias("rows"),
        F.count_if(status == "marker").alias("markers"), (F.unix_micros(F.max(F.when(own, F.col("received_at")))) / 1e6).alias("last"),
    )


class Observer(StreamingQueryListener):
    """Takes what observed() tells of each batch into series, and notes a sample of every series after it."""

    def __init__(self, series: Series, name: str = "frames"):
        self.series, self.name, self.ended = series, name, threading.Event()

    def onQueryStarted(self, event):  # noqa: N802
        self.ended.clear()

    def onQueryProgress(self, event):  # noqa: N802
        row = (event.progress.observedMetrics or {}).get(self.name)
        if row is None:
            return
        for stream in STREAMS:
            self.series.add("frames_total", row[stream] or 0, stream=stream)
        self.series.add("parse_errors_total", row["errors"] or 0)
        self.series.add("rows_submitted_total", row["rows"] or 0)
        if row["last"] is not None:
            self.series.put("last_frame_timestamp_seconds", row["last"])
        self.series.snapshot()

    def onQueryTerminated(self, event):  # noqa: N802
        self.ended.set()


def count_batch(series: Series, gaps: DataFrame, flags: DataFrame) -> None:
    """Count a batch's gaps and flags by their labels."""
    for r in gaps.groupBy("symbol", "cause").agg(F.count("*").alias("n")).toLocalIterator():
        series.add("depth_gaps_total", r.n, symbol=r.symbol or "", cause=r.cause)
    for r in flags.groupBy("symbol", "detector").agg(F.count("*").alias("n")).toLocalIterator():
        series.add("anomaly_flags_total", r.n, symbol=r.symbol or "", detector=r.detector)
    series.snapshot()
