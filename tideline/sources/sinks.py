"""Sinks: idempotent first-wins appends, ordered content hashes, per-batch writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tideline.schemas import DAILY, KEYS, TABLES, broken, conformed, enforced
from tideline.sources.shared import dropped, settled


def first_wins(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """One row per key: the first by order. Formed by a partial aggregation, so repeats don't travel."""
    columns = [c for c in df.columns]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("__first"))
    return first.select("__first.*")


def only_new(staged: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Staged rows whose key isn't stored; a null in a key equals a null."""
    old = stored.select(*(F.col(k).alias(f"__{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return staged.join(old, same, "left_anti")


#: Days of a batch that are named one by one to prune a table; beyond, the days from its first to its last are read.
DAYS = 1000
#: Types of keys whose bounds Parquet keeps for its row groups.
_ORDERED = ("bigint", "int", "string", "timestamp", "date")


def overlapping(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a stored table that can have keys of fresh: of its days, and between the least and the greatest of each key.

    The bounds are literals, so they reach the scan: files are sorted by key and row groups that lie outside aren't read.
    A batch that goes on where the table ends reads footers only, however large the day is.
    """
    kinds = dict(fresh.dtypes)
    own = [k for k in keys if kinds[k] in _ORDERED]
    plain = {k: F.unix_micros(k) if kinds[k] == "timestamp" else F.col(k) for k in own}
    row = fresh.agg(*(f(plain[k]).alias(f"{n}_{k}") for k in own for n, f in (("low", F.min), ("high", F.max))), *(F.count_if(F.col(k).isNull()).alias(f"none_{k}") for k in own)).first()
    for k in own:
        low, high = (F.timestamp_micros(F.lit(v)) if kinds[k] == "timestamp" else F.lit(v) for v in (row[f"low_{k}"], row[f"high_{k}"]))
        within = F.lit(False) if row[f"low_{k}"] is None else F.col(k).between(low, high)
        stored = stored.where(within | F.col(k).isNull() if row[f"none_{k}"] else within)
    if "date" in fresh.columns:
        days = [r[0] for r in fresh.select("date").distinct().limit(DAYS + 1).collect()]
        if len(days) <= DAYS:
            named = F.col("date").isin([d for d in days if d is not None]) if any(d is not None for d in days) else F.lit(False)
            stored = stored.where(named | F.col("date").isNull() if None in days else named)
    return stored


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at path; None if there are no files yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(hadoop):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # an empty folder
        return None


def merge(df: DataFrame, path: str, table: str, *, order: str = "seq", partition: str | None = None, strict: bool = False) -> int:
    """Append what isn't stored yet, and say how many rows that was; running it again with the same rows changes nothing, null keys or not.

    Of the table only what can hold the batch's keys is read (see overlapping); the batch's rows are written sorted by key.
    An append shows as a whole or not at all, and a batch that failed can be run again. A table has one writer at a time.
    With strict, a batch with a row that breaks the table's constraints fails, and none of it is stored.
    """
    keys = KEYS[table]
    df = enforced(df, table) if strict else df
    fresh = first_wins(df, keys, order) if order in df.columns else df.dropDuplicates(keys)
    fresh = fresh.drop("seq", "piece")
    if partition:
        fresh = fresh.withColumn("date", F.to_date(partition))
    old = read_or_none(df.sparkSession, path)
    if old is None:
        return append(fresh.sortWithinPartitions(*(["date"] if partition else []), *keys), path, by="date" if partition else None)
    fresh = settled(fresh, "staged")
    new = only_new(fresh, overlapping(old, fresh, keys), keys)
    n = append(new.sortWithinPartitions(*(["date"] if partition else []), *keys), path, by="date" if partition else None)
    dropped(fresh)
    return n


def rejected(df: DataFrame, table: str) -> DataFrame:
    """The rows that break constraints of a table, with an array of what they break."""
    return df.withColumn("broken", broken(table)).where(F.size("broken") > 0)


def set_up(spark: SparkSession, root: str) -> list[str]:
    """Make the stored tables that aren't there yet, empty; says which. Running it again changes nothing."""
    made = []
    for table, schema in TABLES.items():
        if read_or_none(spark, f"{root}/{table}") is None:
            empty = spark.createDataFrame([], schema)
            (empty.withColumn("date", F.to_date("time")) if table in DAILY else empty).write.mode("append").parquet(f"{root}/{table}")
            made.append(table)
    return made


def stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table that merge() made below root; empty if there is none yet."""
    found = read_or_none(spark, f"{root}/{table}")
    return spark.createDataFrame([], TABLES[table]) if found is None else conformed(found, table)


def table_stats(spark: SparkSession, path: str) -> DataFrame:
    """Of a stored table: rows, files, bytes, days (partitions), and the first and last time of its rows."""
    df = spark.read.parquet(path)
    file, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
    day = F.col("date") if "date" in df.columns else F.lit(None).cast("date")
    files = df.groupBy(file.alias("file")).agg(F.count("*").alias("n"), F.max(size).alias("bytes"), F.min("time").alias("first"), F.max("time").alias("last"), F.max(day).alias("day"))
    return files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("n_bytes"), F.count_distinct("day").alias("n_days"), F.min("first").alias("first_time"), F.max("last").alias("last_time"))


def explained(df: DataFrame) -> tuple[str, float]:
    """The physical plan, and the seconds that running it took (the rows go nowhere)."""
    import time

    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - began
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")), seconds


def append(df: DataFrame, path: str, *, by: str | None = None) -> int:
    """Append all rows, also those that are stored already; says how many they were."""
    count = Observation()
    writer = df.observe(count, F.count(F.lit(1)).alias("n")).write.mode("append")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return count.get.get("n", 0)  # nothing is observed where the optimizer finds no rows


def content_hash(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A row with the number of rows and a digest that doesn't depend on their order, from partial sums."""
    columns = columns or df.columns
    row = F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.to_json(F.struct(c)), F.lit("null")) for c in columns)), 256)
    parts = [F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = df.select(row.alias("h")).agg(F.count("*").alias("n_rows"), *(F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)))
    return sums.select("n_rows", F.sha2(F.concat_ws(":", *(F.coalesce(F.col(f"s{i}").cast("string"), F.lit("0")) for i in range(4))), 256).alias("digest"))


def ordered_hash(df: DataFrame, order: list[str]) -> str:
    """SHA-256 of the rows as JSON lines in order; streams through the driver, for small tables and tests."""
    import hashlib

    h = hashlib.sha256()
    for row in df.orderBy(*order).select(F.to_json(F.struct(*df.columns)).alias("j")).toLocalIterator():
        h.update(row.j.encode() + b"\n")
    return h.hexdigest()
