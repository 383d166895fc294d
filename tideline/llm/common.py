"""Helpers that the corpus operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sources.shared import dropped, shared_dir

__all__ = ["ARROW_BYTES", "ARROW_ROWS", "arrow_bounds", "crc_mod5", "dropped", "held", "lean", "met", "settled", "shared_dir", "table", "text_or_empty", "trimmed"]

#: Rows and bytes of an Arrow batch at most. Texts can be long, so what a Python worker holds at once is bounded by bytes.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_bounds(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers. The bounds are the same for all operators, as they are read when a plan runs."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is executed within deletes its shuffle files when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors, leaves no shuffle files."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    with shuffles_end(spark):
        # small row groups: a writer holds one in memory
        df.write.option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_mod5(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5


#: Rows of a table of single keys, and bytes of their keys, up to which it is broadcast (with a few short values each).
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20
#: Rows of a key from which on it is dealt out; more where that would be over MOST keys, which are broadcast.
HOT_ROWS, MOST_HOT = 100_000, 1_000_000


def met(rows: DataFrame, heads: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """rows joined with heads (one row for each value of on), however many rows one value has. how: inner, left, left_semi or left_anti.

    heads is broadcast where it has BROADCAST_ROWS rows and BROADCAST_BYTES bytes of keys at most. Else a value with more than HOT_ROWS rows (or a millionth of all
    rows, if that is more, so that there are a million such values at most) is dealt to several tasks, by a hash of the
    whole row, and its row of heads goes to each of them. Both tables are read more than once: settle them first.
    """
    length = F.octet_length(on) if dict(heads.dtypes)[on] in ("string", "binary") else F.lit(8)
    n, size = heads.agg(F.count("*"), F.sum(length)).first()
    if n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(heads), on, how)
    many = max(HOT_ROWS, rows.count() // MOST_HOT)
    hot = rows.groupBy(on).agg(F.count("*").alias("__n")).where((F.col("__n") > many) & F.col(on).isNotNull()).select(on, F.ceil(F.col("__n") / many).cast("int").alias("__deal"))
    hot = settled(hot, "hot")
    deal = F.coalesce("__deal", F.lit(1))
    whole = F.xxhash64(*(F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and kind != "variant"))
    # null keys meet nothing, and go anywhere
    salted = rows.join(F.broadcast(hot), on, "left").withColumn("__salt", F.pmod(whole, F.when(F.col(on).isNull(), 1 << 20).otherwise(deal)).cast("int"))
    each = heads.join(F.broadcast(hot), on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), deal - 1))).drop("__deal")
    return salted.drop("__deal").join(each, [on, "__salt"], how).drop("__salt")


def slimmed(spark: SparkSession) -> None:
    """Have the executors' JVMs collect their garbage, upon which they give free heap back to the system.

    A JVM keeps the heap that one operator's garbage filled; Python workers of the next one need room beside it. There are
    as many tasks as cores, so every idle executor gets some.
    """
    cores = max(1, spark.sparkContext.defaultParallelism)
    spark.range(0, cores, 1, cores).select(F.expr("java_method('java.lang.System', 'gc')").alias("done")).collect()


_slot: list = [None, None]


def trimmed() -> None:
    """Give memory that is free back to the system, so that a worker isn't as large as its largest task for ever."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def held(key: tuple, make: Callable):
    """What make() gave for key, once per worker. A worker holds one such thing at a time: operators that follow don't add up."""
    if _slot[0] != key:
        _slot[:] = [None, None]
        gc.collect()
        trimmed()
        _slot[:] = [key, make()]
    return _slot[1]


def lean(run: Callable) -> Callable:
    """A function of batches that gives free memory back when it has ended."""

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trimmed()

    return ended
