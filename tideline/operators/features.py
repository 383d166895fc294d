"""Features of each symbol in buckets of fixed width, on one clock for all symbols.

The clock is the running maximum of the bucket of receive time, so late rows fall into the open bucket. Between two
clock values at most max_fill + 1 buckets apart all buckets are emitted; over a longer silence only the first is, and a
new era begins, in which quotes from before don't count. The last open bucket is never emitted. From a symbol's first
bucket on, each emitted bucket has a row for it.

The clocked events, the clock (a row per bucket with events) and the buckets' sums are each written once to the shared
folder, so no branch works anything out again. Windows run within pieces of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.running import carried, neighbour, one_piece, pieced, running_max
from tideline.sources.shared import settled

SECOND_US = 1_000_000
MAX_FILL = 5
#: Buckets of a piece of the clock and of a symbol's rows.
BUCKETS = 50_000
#: Buckets in a cell of the grid of buckets and symbols.
CELL = 4096


def clocked(trades: DataFrame, quotes: DataFrame, width_us: int = SECOND_US) -> DataFrame:
    """Trades and quotes as one stream with piece, us (receive time) and b (the clock's bucket)."""
    place = [c for c in ("seq", "piece") if c in trades.columns]
    t = trades.select(*place, "symbol", "received_at", F.lit(True).alias("is_trade"), F.col("qty"), (F.col("price") * F.col("qty")).alias("amount"), F.lit(None).cast("double").alias("mid"), F.lit(None).cast("double").alias("spread"))
    bid, ask = F.col("bid").cast("double"), F.col("ask").cast("double")
    mid = (bid + ask) / 2
    q = quotes.select(*place, "symbol", "received_at", F.lit(False).alias("is_trade"), F.lit(None).cast(t.schema["qty"].dataType).alias("qty"), F.lit(None).cast(t.schema["amount"].dataType).alias("amount"), mid.alias("mid"), ((ask - bid) / mid * 1e4).alias("spread"))
    rows = t.unionByName(q).withColumn("us", F.unix_micros("received_at")).drop("received_at")
    floor = F.col("us") - F.pmod(F.col("us"), F.lit(width_us))
    return running_max(rows if "piece" in place else pieced(rows, "seq"), floor, "seq", "b")


def _cell(b: str, width_us: int, buckets: int) -> Column:
    return F.floor(F.col(b) / F.lit(width_us * buckets))


def _bucket_piece(b: str, width_us: int, least: int | None, most: int | None) -> Column:
    """The piece of a bucket; all of one where those between least and most are."""
    size = width_us * BUCKETS
    return one_piece() if least is None or least // size == most // size else _cell(b, width_us, BUCKETS).alias("piece")


def eras(events: DataFrame, width_us: int = SECOND_US, max_fill: int = MAX_FILL) -> DataFrame:
    """b, era (its first bucket) and upto (the last bucket emitted before the next clock value; null for the last), for each clock value."""
    clock = settled(events.select("b").distinct(), "clock")
    least, most = clock.agg(F.min("b"), F.max("b")).first()
    clock = clock.select("*", _bucket_piece("b", width_us, least, most))
    near = neighbour(neighbour(clock, [], "b", F.col("b"), "next", after=True), [], "b", F.col("b"), "prev")
    far = (max_fill + 1) * width_us
    begun = F.when(F.col("prev").isNull() | (F.col("b") - F.col("prev") > far), F.col("b"))
    out = running_max(near, begun, "b", "era")
    return out.select("b", "era", F.when(F.col("next") - F.col("b") > far, F.col("b")).otherwise(F.col("next") - width_us).alias("upto"))


def grid(clock: DataFrame, symbols: DataFrame, last: int, width_us: int) -> DataFrame:
    """symbol, era and k for every emitted bucket k from a symbol's first on: an equal join on cells of buckets."""
    step, cell = F.lit(width_us).cast("bigint"), lambda b: _cell(b, width_us, CELL)
    buckets = clock.where("upto is not null").select("era", F.explode(F.sequence("b", "upto", step)).alias("k")).withColumn("cell", cell("k"))
    own = symbols.where(F.col("first") <= last).withColumn("last", F.lit(last)).withColumn("cell", F.explode(F.sequence(cell("first"), cell("last"))))
    return buckets.join(own, "cell").where("k >= first").select("symbol", "era", "k")


def build_features(trades: DataFrame, quotes: DataFrame, *, width_us: int = SECOND_US, max_fill: int = MAX_FILL, symbol: str | None = None) -> DataFrame:
    """The feature rows (of one symbol, if it is named); time is the bucket's start. trades and quotes have seq, and piece where they have been cut already."""
    events = settled(clocked(trades, quotes, width_us), "clocked")
    clock = settled(eras(events, width_us, max_fill), "eras")
    first, *bounds = clock.agg(F.min("b"), F.max("upto"), F.max("b")).first()
    last, open_ = (-1 << 62 if x is None else x for x in bounds)
    if symbol is not None:
        events = events.where(F.col("symbol") == symbol)
    step = F.lit(width_us).cast("bigint")
    ends = clock.groupBy("era").agg(F.max("upto").alias("end"))
    quoted = events.where("not is_trade").select("piece", "seq", "symbol", "us", "b", "spread").join(clock.join(ends, "era").select("b", "era", "end"), "b").where("b <= end")
    held = neighbour(quoted, ["symbol"], "seq", F.struct("b", "us", "era"), "next", after=True)
    following = lambda c: F.when(F.col("next.era") == F.col("era"), F.col(f"next.{c}"))
    held = held.withColumns({"next_b": following("b"), "next_us": following("us")})
    held = held.withColumn("k", F.explode(F.sequence("b", F.least(F.coalesce("next_b", "end"), "end"), step)))
    until = F.when(F.col("next_b") == F.col("k"), F.col("next_us")).otherwise(F.col("k") + width_us)
    held = held.withColumn("held", F.greatest(F.lit(0).cast("bigint"), until - F.greatest("us", "k")))
    symbols = events.groupBy("symbol").agg(F.min("b").alias("first"))
    # buckets of the grid, events and held quotes meet in one aggregation
    kinds = {"era": "bigint", "is_trade": "boolean", "qty": events.schema["qty"].dataType, "amount": events.schema["amount"].dataType, "mid": "double", "seq": events.schema["seq"].dataType, "weighed": "double", "held": "bigint"}
    wide = lambda df: df.select("symbol", "k", *(F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in kinds.items()))
    parts = wide(grid(clock, symbols, last, width_us)), wide(events.where(F.col("b") < open_).withColumn("k", F.col("b"))), wide(held.select("symbol", "k", (F.col("spread") * F.col("held")).alias("weighed"), "held"))
    summed = parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy("symbol", "k").agg(
        F.max("era").alias("era"), F.count_if("is_trade").cast("int").alias("trade_count"), F.sum("qty").cast("double").alias("volume"), F.sum("amount").cast("double").alias("notional"),
        F.max_by("mid", F.when(F.col("mid").isNotNull(), F.col("seq"))).alias("own"), F.try_divide(F.sum("weighed"), F.sum("held")).alias("spread_bps"),
    )
    rows = settled(summed.where("era is not null"), "buckets").select("*", _bucket_piece("k", width_us, first, open_))
    rows = carried(rows, ["symbol", "era"], "k", "own", "mid", previous="before")
    return rows.select(
        F.timestamp_micros("k").alias("time"), "symbol", "trade_count", F.coalesce("volume", F.lit(0.0)).alias("volume"), F.coalesce("notional", F.lit(0.0)).alias("notional"),
        "spread_bps", "mid", (F.abs(F.log(F.col("mid") / F.col("before"))) * 1e4).alias("abs_return_bps"),
    )
