"""The queries behind dashboards: latest rows, values per interval, recent rows, annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval(time: str, seconds: int) -> Column:
    us = F.unix_micros(time)
    return F.timestamp_micros(us - F.pmod(us, F.lit(seconds * 1_000_000)))


def latest(df: DataFrame, key: str, columns: list[str], order: tuple[str, ...]) -> DataFrame:
    """The latest row of each key: one row per key and task is all that travels."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r")).select(key, "r.*")


def between(df: DataFrame, start: str | None, end: str | None, time: str = "time") -> DataFrame:
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(time) <= F.lit(end).cast("timestamp"))
    return df


def mid_per_interval(features: DataFrame, symbol: str, seconds: int) -> DataFrame:
    """Mean mids; mids have nine decimal places, so their sum is exact and doesn't depend on the order of rows."""
    total = F.sum(F.col("mid").cast("decimal(38,9)")).cast("double")
    return features.where(F.col("symbol") == symbol).groupBy(interval("time", seconds).alias("time")).agg((total / F.count("mid")).alias("mid"))


def spread_per_interval(features: DataFrame, seconds: int) -> DataFrame:
    return features.where("spread_bps is not null").groupBy(interval("time", seconds).alias("time"), "symbol").agg(F.max("spread_bps").alias("spread_bps"))


def recent_flags(flags: DataFrame, n: int = 200) -> DataFrame:
    """The latest flags, their features as JSON text."""
    return flags.orderBy(F.desc("time"), "symbol", "detector").limit(n).select("time", "symbol", "detector", F.round("score", 2).alias("score"), F.round("threshold", 2).alias("threshold"), F.to_json("features").alias("features"))


def recent_gaps(gaps: DataFrame, n: int = 100) -> DataFrame:
    return gaps.orderBy(F.desc("time"), "symbol", "prev_final_update_id").limit(n).select("time", "symbol", "cause", "missing_update_ids", "prev_final_update_id", "first_update_id")


def flag_annotations(flags: DataFrame, detector: str) -> DataFrame:
    text = F.concat(F.col("symbol"), F.lit(" "), F.col("detector"), F.lit(" score "), F.format_string("%.2f", F.round("score", 2)))
    return flags.where(F.col("detector") == detector).select("time", text.alias("text"))
