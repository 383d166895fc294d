"""Frames to typed records. A frame that can't be read is counted as an error, never fatal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.schemas import DECIMAL

_FIELDS = ("e", "E", "s", "t", "p", "q", "T", "m", "U", "u", "b", "a", "B", "A")
#: Names that don't rely on case.
_NAMES = ("kind", "event_ms", "s", "trade", "p", "q", "trade_ms", "m", "first_id", "last_id", "bid", "ask", "bid_qty", "ask_qty")


def _long(c: str) -> Column:
    return F.col(c).try_cast("bigint")


def _levels(c: str) -> Column:
    return F.from_json(F.col(c), "array<array<string>>")


def decoded(raw: DataFrame) -> DataFrame:
    """raw with status (marker, comment, trade, depth, quote, other or error) and the fields of its frame as text.

    json_tuple reads a frame once and tells names apart by case. A quote is known by its stream, as it has no kind.
    """
    kept = raw.columns
    outer = raw.withColumn("payload", F.col("payload").cast("string")).select(*kept, F.json_tuple("payload", "stream", "data").alias("stream", "data"))
    out = outer.select(*kept, "stream", "data", F.json_tuple("data", *_FIELDS).alias(*_NAMES))
    money = lambda *cs: F.lit(True) if not cs else _all(*(F.col(c).try_cast(DECIMAL).isNotNull() for c in cs))
    ids = lambda *cs: _all(*(_long(c).isNotNull() for c in cs))
    quote = _all(F.col("s").isNotNull(), ids("last_id"), money("bid", "bid_qty", "ask", "ask_qty"))
    trade = _all(F.col("s").isNotNull(), ids("trade", "trade_ms", "event_ms"), money("p", "q"), F.col("m").try_cast("boolean").isNotNull())
    depth = _all(F.col("s").isNotNull(), ids("event_ms", "first_id", "last_id"), _levels("bid").isNotNull(), _levels("ask").isNotNull())
    status = (
        F.when(F.col("payload") == "#connected", "marker")
        .when(F.startswith("payload", F.lit("#")), "comment")
        .when(F.col("data").isNull() | F.col("stream").isNull(), "error")
        .when(F.endswith("stream", F.lit("@bookTicker")), F.when(quote, "quote").otherwise("error"))
        .when(F.col("kind").isNull(), "error")
        .when(F.col("kind") == "trade", F.when(trade, "trade").otherwise("error"))
        .when(F.col("kind") == "depthUpdate", F.when(depth, "depth").otherwise("error"))
        .otherwise("other")
    )
    return out.withColumn("status", status)


def _all(*conditions: Column) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


def typed(frames: DataFrame) -> DataFrame:
    """Trades, depth updates, quotes and markers with typed columns, in one narrow table; fields of other kinds are null."""
    kind = lambda *ks: F.col("status").isin(*ks)
    of = lambda c, *ks: F.when(kind(*ks), c)
    money = lambda c, *ks: of(F.col(c).try_cast(DECIMAL), *ks)
    return frames.where(kind("trade", "depth", "quote", "marker")).select(
        "seq", "received_at", "status", of(F.col("s"), "trade", "depth", "quote").alias("symbol"),
        F.timestamp_millis(F.when(kind("trade"), _long("trade_ms")).when(kind("depth"), _long("event_ms"))).alias("time"),
        of(F.timestamp_millis(_long("event_ms")), "trade").alias("event_time"), of(_long("trade"), "trade").alias("trade_id"),
        money("p", "trade").alias("price"), money("q", "trade").alias("qty"), of(F.col("m").try_cast("boolean"), "trade").alias("buyer_is_maker"),
        of(_long("first_id"), "depth").alias("first_update_id"), of(_long("last_id"), "depth").alias("final_update_id"), of(_levels("bid"), "depth").alias("bids"), of(_levels("ask"), "depth").alias("asks"),
        of(_long("last_id"), "quote").alias("update_id"), *(money(c, "quote").alias(c) for c in ("bid", "bid_qty", "ask", "ask_qty")),
    )


def _place(records: DataFrame) -> list[str]:
    return [c for c in ("seq", "piece") if c in records.columns]


def trades(records: DataFrame) -> DataFrame:
    """The trades of typed() records."""
    return records.where("status = 'trade'").select(*_place(records), "time", "symbol", "trade_id", "price", "qty", "buyer_is_maker", "event_time", "received_at")


def depth(records: DataFrame) -> DataFrame:
    return records.where("status = 'depth'").select(*_place(records), "time", "symbol", "first_update_id", "final_update_id", "bids", "asks", "received_at")


def quotes(records: DataFrame) -> DataFrame:
    """Quotes; those without a positive mid price have no spread and no return, and go."""
    return records.where("status = 'quote' and bid + ask > 0").select(*_place(records), "symbol", "update_id", "bid", "bid_qty", "ask", "ask_qty", "received_at")


def markers(records: DataFrame) -> DataFrame:
    return records.where("status = 'marker'").select(*_place(records), "received_at")
