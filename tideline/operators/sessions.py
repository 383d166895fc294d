"""Sessions: runs of a key's rows with no silence longer than a given one between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.running import carried, neighbour, pieced

#: What a session has: its first and last time, and its rows.
AGGREGATES = lambda time: (F.min(time).alias("began"), F.max(time).alias("ended"), F.count("*").alias("n_rows"))


def sessions(df: DataFrame, by: list[str], time: str, gap_s: Column) -> DataFrame:
    """by, began, ended and n_rows. A row begins a session if the one before it of its key is more than gap_s (a column of it, seconds) back.

    Rows are cut along time into pieces of bounded size; where a session begins is carried over their edges, so neither a
    hot key nor an endless session is one task. Rows without a time belong to no session.
    """
    rows = pieced(df.where(F.col(time).isNotNull()).select(*by, F.col(time).alias("at"), gap_s.cast("double").alias("gap"), F.monotonically_increasing_id().alias("id")).withColumn("o", F.struct("at", "id")), "o")
    near = neighbour(rows, by, "o", F.col("at"), "before")
    fresh = F.col("before").isNull() | ((F.unix_micros("at") - F.unix_micros("before")) / 1e6 > F.col("gap"))
    starts = carried(near.withColumn("start", F.when(fresh, F.col("at"))), by, "o", "start", "session")
    return starts.groupBy(*by, "session").agg(*AGGREGATES("at")).drop("session")


def session_stream(df: DataFrame, by: list[str], time: str, gap_s: Column, late: str) -> DataFrame:
    """The same over a stream: sessions are given once the watermark has passed their end, and their state goes."""
    gap = F.concat(gap_s.cast("string"), F.lit(" seconds"))
    return df.withWatermark(time, late).groupBy(F.session_window(time, gap), *by).agg(*AGGREGATES(time)).drop("session_window")
