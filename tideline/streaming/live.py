"""The live side: gaps, features and flags as a keyed stateful stream, idempotent sinks per batch, windowed counts, progress.

Symbols are dealt over KEYS keys by their hash. All that a symbol's rows are made of is in its key's state: the last depth
update, the open bucket, the quote that was carried into it and the rows that detectors look back on, as typed values (a map
from symbol to each), checkpointed, so a stream that starts again goes on where it was. What all symbols share is little and
goes to every key: connection markers, and ticks, the first row of each bucket in each Arrow batch. The running maximum of
the ticks up to a row is the clock of all symbols, so no key needs another one's rows.

The rows of a batch are taken in the order of seq, and batches must come in order (a folder of archive files does, and so
does ordered_stream()); a key's rows of a batch are held at once, so bound it by maxFilesPerTrigger or maxframes. Symbols
never expire, as in the replay.
"""

from __future__ import annotations

import json
import logging
import math
import time
from collections.abc import Iterator
from contextlib import nullcontext

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, StructType, TimestampType

from tideline.functions import decode
from tideline.operators import detectors
from tideline.operators.features import MAX_FILL, SECOND_US
from tideline.plans.replay import Settings
from tideline.sources import archive, sinks
from tideline.streaming.observed import Series, count_batch, observed

log = logging.getLogger("tideline.stream")

FEATURES = ("time_us", "symbol", "trade_count", "volume", "notional", "spread_bps", "mid", "abs_return_bps")
OUTPUT = (
    "kind string, time_us bigint, symbol string, trade_count int, volume double, notional double, spread_bps double, mid double, abs_return_bps double, prev_final_update_id bigint, "
    "first_update_id bigint, missing_update_ids bigint, cause string, received_us bigint, detector string, score double, threshold double, features string"
)
_COLUMNS = tuple(c.split(" ")[0] for c in OUTPUT.split(", "))
#: Keys over which symbols are dealt. A stream keeps the number it began with.
KEYS = 32
#: What a stream can give: gaps, feature rows, and the flags of each detector.
KINDS = ("gap", "feature", "zscore", "iforest")
#: Frames of a file of ordered_stream(), about, and files of a batch.
FRAMES, FILES = 62_500, 16
#: Rows that a key gives at once.
ROWS = 10_000


class LiveBuckets:
    """The open bucket: what each symbol traded in it, the quotes that came in it and the one that was carried into it.

    A bucket is worked out when the clock passes its end.
    """

    def __init__(self, width_us: int = SECOND_US, max_fill: int = MAX_FILL):
        self.width, self.fill, self.open, self.symbols = width_us, max_fill, None, {}

    def feed(self, us: int, symbol: str, trade: tuple[float, float] | None, quote: tuple[float, float] | None) -> Iterator[tuple]:
        """trade: quantity and amount; quote: mid and spread. Gives the rows of the buckets that this row closes."""
        yield from self.tick(us)
        own = self.symbols.setdefault(symbol, {"n": 0, "qty": 0.0, "amount": 0.0, "quotes": [], "carried": None, "mid": None})
        if trade:
            own["n"] += 1
            own["qty"] += trade[0]
            own["amount"] += trade[1]
        if quote:
            own["quotes"].append([us, *quote])

    def tick(self, us: int) -> Iterator[tuple]:
        """The clock is at least here."""
        bucket = us - us % self.width
        if self.open is None:
            self.open = bucket
        if bucket > self.open:
            yield from self._close(bucket)

    def _close(self, bucket: int) -> Iterator[tuple]:
        silent = bucket - self.open > (self.fill + 1) * self.width
        for at in [self.open] if silent else range(self.open, bucket, self.width):
            for symbol, own in self.symbols.items():
                yield self._row(at, symbol, own)
        if silent:
            for own in self.symbols.values():
                own["carried"] = own["mid"] = None
        self.open = bucket

    def _row(self, at: int, symbol: str, own: dict) -> tuple:
        points = ([[at, *own["carried"]]] if own["carried"] else []) + own["quotes"]
        ends = [p[0] for p in points[1:]] + [at + self.width]
        held = [max(0, end - max(p[0], at)) for p, end in zip(points, ends, strict=False)]
        spread = sum(h * p[2] for h, p in zip(held, points, strict=True)) / sum(held) if sum(held) else None
        mid = points[-1][1] if points else None
        moved = abs(math.log(mid / own["mid"])) * 1e4 if mid is not None and own["mid"] is not None else None
        row = (at, symbol, own["n"], own["qty"], own["amount"], spread, mid, moved)
        own.update(n=0, qty=0.0, amount=0.0, quotes=[], carried=points[-1][1:] if points else None, mid=mid)
        return row


class LiveGaps:
    """Markers so far, and each symbol's last update with the markers that had come before it."""

    def __init__(self):
        self.markers, self.last = 0, {}

    def marker(self) -> None:
        self.markers += 1

    def feed(self, symbol: str, first: int, final: int) -> tuple[int, int, str] | None:
        """The previous update's id, the number of ids that are missing and the cause, if first doesn't follow on it."""
        epoch, before = max(1, self.markers), self.last.get(symbol)
        self.last[symbol] = (final, epoch)
        if before is None or first == before[0] + 1:
            return None
        return before[0], first - before[0] - 1, "reconnect" if epoch > before[1] else "stream"


class LiveScores:
    """Each symbol's last rows that can be scored, and their number: what the detectors (those of kinds) need."""

    def __init__(self, settings: Settings, kinds: tuple[str, ...] = KINDS):
        self.settings, self.rows, self.seen = settings, {}, {}
        self.detectors = {*kinds} & {"zscore", "iforest"}
        self.forests: dict[str, tuple] = {}

    def feed(self, symbol: str, x: np.ndarray) -> Iterator[tuple[str, float, float, dict]]:
        """The detectors' flags of a row: detector, score, threshold and features."""
        s, rows = self.settings, self.rows.setdefault(symbol, [])
        named = dict(zip(detectors.NAMES, x.tolist(), strict=True))
        if "zscore" in self.detectors and len(rows) >= s.min_samples:
            z = detectors.zscore_of(np.array(rows[-s.window :]), x)
            if (score := float(np.abs(z).max())) > s.threshold:
                yield "zscore", score, float(s.threshold), named | {f"z_{n}": v for n, v in zip(detectors.NAMES, z.tolist(), strict=True)}
        rows.append(x.tolist())
        seen = self.seen[symbol] = self.seen.get(symbol, 0) + 1
        swap = max(s.swap_after, 1)
        step = max(s.refit_every, swap)
        fits = "iforest" in self.detectors
        if fits and seen >= s.train_window + swap:
            fit = (seen - s.train_window - swap) // step
            if self.forests.get(symbol, (None,))[0] != fit:
                back = seen - (s.train_window + fit * step)  # rows after the fit's last one
                train = np.array(rows[len(rows) - back - s.train_window : len(rows) - back])
                forest = detectors.IsolationForest(train, trees=s.trees)
                self.forests[symbol] = (fit, forest, float(np.quantile(forest.score(train), s.quantile)))
            _, forest, threshold = self.forests[symbol]
            if (score := float(forest.score(x[None])[0])) > threshold:
                yield "iforest", score, threshold, named
        kept = max(s.window, s.train_window + swap + step + 1) if fits else s.window
        del rows[: max(0, len(rows) - kept)]


#: What a key keeps: the open bucket and the number of markers; of each symbol its last update, its bucket with the quotes of
#: it (time, mid and spread, one after the other), and the rows that were scored (four values each).
CLOCK = "open bigint, markers bigint"
UPDATE = "final bigint, epoch bigint"
BUCKET = "n bigint, qty double, amount double, carried array<double>, mid double, quotes array<double>"
SCORED = "seen bigint, rows array<double>"


class Market(StatefulProcessor):
    """Takes decoded frames, markers and ticks of a key in the order of seq and gives rows of OUTPUT."""

    def __init__(self, settings: Settings, kinds: tuple[str, ...] = KINDS):
        self.settings, self.kinds = settings, kinds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clock = handle.getValueState("clock", CLOCK)
        self.updates, self.open, self.scored = (handle.getMapState(name, "symbol string", kind) for name, kind in (("updates", UPDATE), ("buckets", BUCKET), ("scored", SCORED)))

    def close(self) -> None:
        pass

    def _loaded(self) -> tuple[LiveBuckets, LiveGaps, LiveScores]:
        s, width = self.settings, len(detectors.NAMES)
        buckets, gaps, scores = LiveBuckets(s.width_us, s.max_fill), LiveGaps(), LiveScores(s, self.kinds)
        if (clock := self.clock.get()) is not None:
            buckets.open, gaps.markers = clock[0], clock[1]
        gaps.last = {k[0]: tuple(v) for k, v in self.updates.iterator()}
        for (symbol,), (n, qty, amount, carried, mid, quotes) in self.open.iterator():
            points = [[int(quotes[i]), *quotes[i + 1 : i + 3]] for i in range(0, len(quotes), 3)]
            buckets.symbols[symbol] = {"n": n, "qty": qty, "amount": amount, "quotes": points, "carried": list(carried) or None, "mid": mid}
        for (symbol,), (seen, rows) in self.scored.iterator():
            scores.seen[symbol], scores.rows[symbol] = seen, [list(rows[i : i + width]) for i in range(0, len(rows), width)]
        return buckets, gaps, scores

    def _stored(self, buckets: LiveBuckets, gaps: LiveGaps, scores: LiveScores, before: dict[str, int]) -> None:
        self.clock.update((buckets.open, gaps.markers))
        for symbol, last in gaps.last.items():
            self.updates.updateValue((symbol,), last)
        for symbol, x in buckets.symbols.items():
            flat = [float(v) for point in x["quotes"] for v in point]
            self.open.updateValue((symbol,), (x["n"], float(x["qty"]), float(x["amount"]), [float(v) for v in x["carried"] or []], x["mid"], flat))
        for symbol, seen in scores.seen.items():
            if before.get(symbol) != seen:
                self.scored.updateValue((symbol,), (seen, [v for row in scores.rows[symbol] for v in row]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        buckets, gaps, scores = self._loaded()
        before, pdf = dict(scores.seen), pd.concat(list(rows))
        pdf = pdf.sort_values(_places(pdf.columns), kind="stable")
        out: list[dict] = []
        for x in pdf.itertuples(index=False):
            found: Iterator[tuple] = iter(())
            if x.status == "marker":
                gaps.marker()
            elif x.status == "tick":
                found = buckets.tick(x.us)
            elif x.status == "depth":
                if gap := gaps.feed(x.symbol, x.first_update_id, x.final_update_id):
                    out.append({"kind": "gap", "time_us": x.time_us, "symbol": x.symbol, "prev_final_update_id": gap[0], "first_update_id": x.first_update_id, "missing_update_ids": gap[1], "cause": gap[2], "received_us": x.us})
            else:
                found = buckets.feed(x.us, x.symbol, (x.qty, x.amount) if x.status == "trade" else None, (x.mid, x.spread) if x.status == "quote" else None)
            for row in found:
                out += _scored(dict(zip(FEATURES, row, strict=True)), scores, self.kinds)
                if len(out) >= ROWS:
                    yield _table(out)
                    out = []
            if len(out) >= ROWS:
                yield _table(out)
                out = []
        self._stored(buckets, gaps, scores, before)
        yield _table(out)


def _table(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([row.get(c) for row in rows], dtype=object) for c in _COLUMNS})


def _place(seq: Column, kind: DataType) -> list[Column]:
    """A seq as columns place0, place1, ... of plain values by which rows sort."""
    parts = [(seq[f.name], f.dataType) for f in kind.fields] if isinstance(kind, StructType) else [(seq, kind)]
    return [(F.unix_micros(c) if isinstance(t, TimestampType) else c).alias(f"place{i}") for i, (c, t) in enumerate(parts)]


def _places(columns) -> list[str]:
    return [c for c in columns if c.startswith("place")]


def _scored(feature: dict, scores: LiveScores, kinds: tuple[str, ...]) -> Iterator[dict]:
    """A feature row, and the flags that it raises, as far as they are of these kinds."""
    if "feature" in kinds:
        yield {"kind": "feature"} | feature
    if scores.detectors and feature["spread_bps"] is not None and feature["abs_return_bps"] is not None:
        values = np.array([math.log1p(feature["trade_count"]), math.log1p(feature["notional"]), feature["spread_bps"], math.log1p(feature["abs_return_bps"])])
        for detector, score, threshold, named in scores.feed(feature["symbol"], values):
            yield {"kind": "flag", "time_us": feature["time_us"], "symbol": feature["symbol"], "detector": detector, "score": score, "threshold": threshold, "features": json.dumps(named)}


def _ticking(width_us: int):
    """Marks the first row of each bucket of a batch's trades and quotes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            places = _places(pdf.columns)
            own = pdf.loc[pdf["status"].isin(("trade", "quote")), [*places, "us"]]
            first = own.assign(b=own["us"] // width_us).sort_values(places, kind="stable").drop_duplicates("b")
            yield pdf.assign(ticks=pdf.index.isin(first.index))

    return run


def live_rows(raw: DataFrame, settings: Settings = Settings(), *, order: str = "seq", keys: int = KEYS, observe: str | None = None, kinds: tuple[str, ...] = KINDS) -> DataFrame:  # noqa: B008
    """Streaming raw frames (seq, received_at, payload) to streaming rows of OUTPUT: gaps, features and flags, or those of kinds.

    Frames that no row of these kinds is made of go before the keys. With observe, each batch's progress tells the numbers of
    its frames under that name (see observed.py).
    """
    raw.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    frames = decode.decoded(raw.withColumnRenamed(order, "seq") if order != "seq" else raw)
    records = decode.typed(observed(frames, observe) if observe else frames)
    bid, ask = F.col("bid").cast("double"), F.col("ask").cast("double")
    mid = (bid + ask) / 2
    used = (("depth", "marker") if "gap" in kinds else ()) + (("trade", "quote") if {*kinds} - {"gap"} else ())
    exact = lambda c: F.coalesce(c, F.lit(0))  # noqa: E731  # a null would make pandas take the numbers as doubles
    rows = records.where(F.col("status").isin(*used) & F.expr("status <> 'quote' or bid + ask > 0")).select(
        *_place(F.col("seq"), records.schema["seq"].dataType), "status", "symbol", F.unix_micros("received_at").alias("us"), exact(F.unix_micros("time")).alias("time_us"), F.col("qty").cast("double").alias("qty"),
        (F.col("price") * F.col("qty")).cast("double").alias("amount"), mid.alias("mid"), F.try_divide(ask - bid, mid).alias("spread"),
        *(exact(F.col(c)).alias(c) for c in ("first_update_id", "final_update_id")),
    ).withColumn("spread", F.col("spread") * 1e4)
    own = F.pmod(F.xxhash64("symbol"), F.lit(keys)).cast("int")
    every = F.sequence(F.lit(0), F.lit(keys - 1))
    if {*kinds} - {"gap"}:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", ticks boolean"
        rows = rows.mapInPandas(_ticking(settings.width_us), schema)
    else:
        rows = rows.withColumn("ticks", F.lit(False))
    dealt = rows.withColumn("own", own).withColumn("key", F.explode(F.when((F.col("status") == "marker") | F.col("ticks"), every).otherwise(F.array("own"))))
    # to all keys but its own, a row that ticks is a tick
    shared = F.col("ticks") & (F.col("key") != F.col("own"))
    dealt = dealt.withColumn("status", F.when(shared, "tick").otherwise(F.col("status"))).drop("own", "ticks")
    return dealt.groupBy("key").transformWithStateInPandas(Market(settings, kinds), OUTPUT, "append", "none")


def features_of(rows: DataFrame) -> DataFrame:
    """The feature rows of live_rows()."""
    return rows.where("kind = 'feature'").select(F.timestamp_micros("time_us").alias("time"), *FEATURES[1:])


def gaps_of(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'gap'").select(F.timestamp_micros("time_us").alias("time"), "symbol", "prev_final_update_id", "first_update_id", "missing_update_ids", "cause", F.timestamp_micros("received_us").alias("received_at"))


def flags_of(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'flag'").select(F.timestamp_micros("time_us").alias("time"), "symbol", "detector", "score", "threshold", F.from_json("features", "map<string,double>").alias("features"))


def feature_stream(raw: DataFrame, *, width_us: int = SECOND_US, max_fill: int = MAX_FILL, order: str = "seq") -> DataFrame:
    """Streaming raw frames to streaming feature rows."""
    return features_of(live_rows(raw, Settings(width_us=width_us, max_fill=max_fill), order=order, kinds=("feature",)))


def ordered_stream(raw: DataFrame, root: str, frames: int | None = None, files: int | None = None) -> DataFrame:
    """Raw frames (seq, received_at, payload), written to the folder root, as a stream whose batches come in order and have a bounded number of frames.

    A file has about FRAMES frames along seq and a batch FILES files. A stream takes files by the times of their last change,
    which are set in the files' order.
    """
    spark = raw.sparkSession
    n = max(1, -(-raw.count() // (frames or FRAMES)))
    raw.repartitionByRange(n, "seq").sortWithinPartitions("seq").write.parquet(root)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    written = sorted((s.getPath() for s in store.listStatus(hadoop(root)) if s.getPath().getName().startswith("part-")), key=lambda p: (len(p.getName()), p.getName()))
    begun = int(time.time()) - len(written)
    for i, path in enumerate(written):
        store.setTimes(path, (begun + i) * 1000, -1)
    return spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files or FILES).parquet(root)


def store_stream(raw: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Trades and depth updates of streaming raw frames (seq, received_at, payload), merged first-wins batch by batch."""

    def batch(df: DataFrame, _number: int) -> None:
        records = decode.typed(decode.decoded(df)).persist()
        sinks.merge(decode.trades(records), f"{root}/trades", "trades", partition="time")
        sinks.merge(decode.depth(records), f"{root}/depth_updates", "depth_updates", partition="time")
        records.unpersist()

    return raw.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def store_live(raw: DataFrame, root: str, checkpoint: str, settings: Settings = Settings(), trigger: dict | None = None, series: Series | None = None) -> StreamingQuery:  # noqa: B008
    """Gaps, features and flags of streaming raw frames, merged first-wins batch by batch; series takes how many, and how long merges took.

    Frames are counted where an Observer with the same series listens.
    """

    def batch(df: DataFrame, _number: int) -> None:
        rows = df.persist()
        for part, table, partition in ((gaps_of, "depth_gaps", None), (features_of, "features", "time"), (flags_of, "anomaly_flags", "time")):
            with series.timed("flush_seconds") if series else nullcontext():
                sinks.merge(part(rows), f"{root}/{table}", table, partition=partition)
        if series:
            count_batch(series, gaps_of(rows), flags_of(rows))
        rows.unpersist()

    rows = live_rows(raw, settings, observe="frames" if series else None)
    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_counts(raw: DataFrame, seconds: int = 1, late: str = "10 seconds", slide: int | None = None) -> DataFrame:
    """Frames by kind in windows of receive time, once the watermark has passed them; tumbling, or sliding by `slide` seconds."""
    frames = decode.decoded(raw)
    window = F.window("received_at", f"{seconds} seconds", f"{slide or seconds} seconds")
    return frames.withWatermark("received_at", late).groupBy(window, "status").agg(F.count("*").alias("n"))


def first_in_window(records: DataFrame, keys: list[str], late: str = "10 seconds", time: str = "received_at") -> DataFrame:
    """One row per key among rows that come within `late` of each other; the state of older keys goes."""
    return records.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def near_stream(a: DataFrame, b: DataFrame, reach_s: int = 2, late: str = "10 seconds") -> DataFrame:
    """Rows of the stream a (symbol, time) with a row of the stream b within reach_s, each once: a band semi-join of two streams.

    Both have watermarks, so rows of either are held until the other one's has passed them by reach_s, and then go.
    """
    left = a.withWatermark("time", late)
    right = b.select(F.col("symbol").alias("__s"), F.col("time").alias("__t")).withWatermark("__t", late)
    reach = F.expr(f"interval {reach_s} seconds")
    close = (F.col("symbol") == F.col("__s")) & (F.col("__t") >= F.col("time") - reach) & (F.col("__t") <= F.col("time") + reach)
    return left.join(right, close, "left_semi")


def archive_stream(spark: SparkSession, root: str, most_files: int = 100) -> DataFrame:
    """seq, received_at and payload of an archive's files as they get their names; a batch has so many files at most, and is held in order."""
    lines = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", archive.FILES).option("maxFilesPerTrigger", most_files).text(root)
    rows = archive.decoded_lines(lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")))
    return rows.select(F.struct("received_ns", "path", "block", "line").alias("seq"), F.timestamp_micros(F.expr("received_ns div 1000")).alias("received_at"), "payload")


def drained(*queries: StreamingQuery) -> None:
    """Stop queries once they have handled all that has come."""
    for q in queries:
        q.processAllAvailable()
        q.stop()


class Progress(StreamingQueryListener):
    """Rows and batches in all, and a log line every `every` seconds with those since the last line."""

    def __init__(self, every: float = 10.0, clock=time.monotonic, write=log.info):
        self.rows = self.batches = self.new_rows = self.new_batches = 0
        self.every, self.clock, self.write, self.last = every, clock, write, clock()

    def add(self, rows: int) -> None:
        self.rows, self.batches, self.new_rows, self.new_batches = self.rows + rows, self.batches + 1, self.new_rows + rows, self.new_batches + 1
        now = self.clock()
        if now - self.last >= self.every:
            self.write("%d rows in %d batches (%.1f rows/s); %d rows in all" % (self.new_rows, self.new_batches, self.new_rows / (now - self.last), self.rows))
            self.new_rows, self.new_batches, self.last = 0, 0, now

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.add(event.progress.numInputRows)

    def onQueryTerminated(self, event):  # noqa: N802
        pass
