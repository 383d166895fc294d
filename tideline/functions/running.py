"""Running values along a total order without a window over all rows, a symbol or a day.

Rows are cut along the order into pieces of about PIECE rows (`piece`, an integer that never falls along the order), by
range partitions whose bounds Spark samples. Running values are made within pieces; what the pieces before add comes from
a table with a row per piece (and key), PIECE times smaller than the rows. It is joined on the columns that the rows are
dealt by already, so the rows move once, and Spark broadcasts it only where it finds it small. Where all rows are one
piece, `piece` says so in its metadata, and there is nothing to join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.sources.shared import settled

_ONE = {"one": True}

#: Rows of a piece, about.
PIECE = 500_000


def one_piece() -> Column:
    """The piece of rows that are all of one."""
    return F.lit(0).alias("piece", metadata=_ONE)


def _one(df: DataFrame) -> bool:
    return bool(df.schema["piece"].metadata.get("one"))


def pieced(df: DataFrame, *order: str | Column, rows: int | None = None, count: int | None = None) -> DataFrame:
    """df with piece. df is counted unless count says how many rows it has; more than one piece are written to the shared folder."""
    n = -(-(df.count() if count is None else count) // (rows or PIECE))
    if n <= 1:
        return df.select("*", one_piece())
    return settled(df.repartitionByRange(n, *order).withColumn("piece", F.spark_partition_id()), "pieces")


def _before(rows: DataFrame, keys: list[str], last: Column) -> DataFrame:
    """keys, piece and __b: of the pieces before a row's own (of its keys), the last value that isn't null."""
    edges = rows.groupBy(*keys, "piece").agg(last.alias("__l"))
    along = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(*keys, "piece", F.last("__l", ignorenulls=True).over(along).alias("__b"))


def _added(rows: DataFrame, keys: list[str], edges) -> DataFrame:
    """rows with __b, by keys and piece, from edges(); null where all are one piece."""
    return rows.withColumn("__b", F.lit(None)) if _one(rows) else rows.join(edges(), [*keys, "piece"])


def _running(df: DataFrame, value: Column, order: str, name: str, total, combine) -> DataFrame:
    inside = Window.partitionBy("piece").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__v", value)
    edges = lambda: rows.groupBy("piece").agg(total("__v").alias("__t")).select("piece", total("__t").over(before).alias("__b"))
    out = _added(rows.withColumn("__r", total("__v").over(inside)), [], edges)
    return out.withColumn(name, combine(F.col("__r"), F.col("__b"))).drop("__v", "__r", "__b")


def running_max(df: DataFrame, value: Column, order: str, name: str) -> DataFrame:
    """df (with piece) and the greatest value up to each row."""
    return _running(df, value, order, name, F.max, lambda a, b: F.greatest(a, b))


def running_sum(df: DataFrame, value: Column, order: str, name: str) -> DataFrame:
    """df (with piece) and the sum of values up to each row."""
    return _running(df, value, order, name, F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def neighbour(df: DataFrame, keys: list[str], order: str, value: Column, name: str, *, after: bool = False) -> DataFrame:
    """df (with piece) and value (not null) of the row before (or after) each row of its keys; null where there is none."""
    rows = df.withColumn("__v", value)
    inside = Window.partitionBy(*keys, "piece").orderBy(order)
    along = Window.partitionBy(*keys).orderBy("piece")
    pick, shift = (F.min_by, F.lead) if after else (F.max_by, F.lag)
    edges = lambda: rows.groupBy(*keys, "piece").agg(pick("__v", order).alias("__e")).select(*keys, "piece", shift("__e").over(along).alias("__b"))
    out = _added(rows.withColumn("__r", shift("__v").over(inside)), keys, edges)
    return out.withColumn(name, F.coalesce("__r", "__b")).drop("__v", "__r", "__b")


def carried(df: DataFrame, keys: list[str], order: str, value: str, name: str, *, previous: str | None = None) -> DataFrame:
    """df (with piece) and the last value up to each row of its keys that isn't null; previous names what this was a row before."""
    inside = Window.partitionBy(*keys, "piece").orderBy(order)
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    out = _added(df.withColumn("__r", F.last(value, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))), keys, lambda: _before(df, keys, last))
    out = out.withColumn(name, F.coalesce("__r", "__b"))
    if previous:
        out = out.withColumn(previous, F.coalesce(F.lag(name).over(inside), "__b"))
    return out.drop("__r", "__b")


def numbered(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """df (with piece) and the number from 1 of each row within its keys."""
    inside = Window.partitionBy(*keys, "piece").orderBy(order)
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    edges = lambda: df.groupBy(*keys, "piece").agg(F.count("*").alias("__n")).select(*keys, "piece", F.sum("__n").over(before).alias("__b"))
    out = _added(df.withColumn("__r", F.row_number().over(inside)), keys, edges)
    return out.withColumn(name, F.col("__r").cast("bigint") + F.coalesce("__b", F.lit(0))).drop("__r", "__b")


def summed_before(df: DataFrame, keys: list[str], order: str, value: str | list[str], name: str | list[str]) -> DataFrame:
    """df (with piece) and the sum of value over the rows of its keys before each row, 0 for the first; of several values, if so many are named."""
    pairs = list(zip([value], [name], strict=True) if isinstance(value, str) else zip(value, name, strict=True))
    inside = Window.partitionBy(*keys, "piece").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum(v).alias(f"__n{i}") for i, (v, _) in enumerate(pairs)]
    edges = lambda: df.groupBy(*keys, "piece").agg(*sums).select(*keys, "piece", F.struct(*(F.sum(f"__n{i}").over(before).alias(f"b{i}") for i in range(len(pairs)))).alias("__b"))
    out = _added(df.withColumn("__r", F.struct(*(F.sum(v).over(inside).alias(f"r{i}") for i, (v, _) in enumerate(pairs)))), keys, edges)
    earlier = lambda i: F.lit(0) if _one(df) else F.coalesce(F.col("__b")[f"b{i}"], F.lit(0))
    return out.withColumns({n: F.coalesce(F.col("__r")[f"r{i}"], F.lit(0)) + earlier(i) for i, (_, n) in enumerate(pairs)}).drop("__r", "__b")
