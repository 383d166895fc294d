"""Tables in the folder that driver and executors share: intermediate results that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_made: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Only in local mode, where that is unset, a folder is made for it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", base)
    _made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled_count(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """settled(), and how many rows were written: they are counted on the way."""
    count = Observation()
    out = settled(df.observe(count, F.count(F.lit(1)).alias("n")), name)
    return out, count.get.get("n", 0)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that shared_dir() gave."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that settled() made, once nothing reads them any more."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            removed(df.sparkSession, path)


def cleaned(spark: SparkSession) -> None:
    """Delete all that operators have left in the shared folder: for when the results have been read or written elsewhere."""
    while _made:
        removed(spark, _made.pop())


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df, marked to be broadcast if it has at most so many (short) rows; it is counted first."""
    return F.broadcast(df) if df.count() <= rows else df
