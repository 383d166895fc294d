"""Raw archives: `.../YYYY-MM-DD/HH.tsv[.gz]` with lines `<nanoseconds>\\t<payload>`, and recordings of frames.

Raw frames have seq, their place in the total order: day and hour, the running maximum of nanoseconds within a file, path and
place in the file. Several folders can hold the same hour; their frames are merged by receive time. Files are read line by
line, in splits where they can be split, so no file has to fit into a row or a window. A read of a time range opens the
files of its hours only.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: What is read below folders.
FILES = "*.{tsv,tsv.gz}"
#: Files that are moved into their place at once.
MOVERS = 8
_STAGED = re.compile(r"date=(\d{4,}-\d{2}-\d{2})/hour=(\d{2})/[^/]+$")


def _stamp(line: Column) -> Column:
    return F.regexp_extract(line, r"^([0-9]{1,19})\t", 1)


def is_frame(line: Column) -> Column:
    """Whether a line has digits, a tab and a payload."""
    return F.coalesce(F.regexp_like(line, F.lit(r"^[0-9]{1,19}\t(?s:.)")) & _stamp(line).try_cast("bigint").isNotNull(), F.lit(False))


def decoded_lines(lines: DataFrame, value: str = "value", skipped: Observation | None = None) -> DataFrame:
    """Adds received_ns and payload; rows without a tab, with a stamp that isn't all digits or an empty payload go, and are counted by skipped (n)."""
    line = F.regexp_replace(F.col(value), r"\r?\n$", "")
    if skipped is not None:
        lines = lines.observe(skipped, F.count_if(~is_frame(line)).alias("n"))
    return lines.where(is_frame(line)).withColumns({"received_ns": _stamp(line).try_cast("bigint"), "payload": F.substr(line, F.instr(line, "\t") + 1)})


def _files_and_folders(spark: SparkSession, paths: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """The paths that are files and those that are folders, each once; folders and files below another folder that is read go."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    files, folders = set(), set()
    for p in paths:
        path = hadoop(p)
        status = path.getFileSystem(conf).getFileStatus(path)
        (folders if status.isDirectory() else files).add(status.getPath().toString())
    above = [f for f in folders if not any(f != g and f.startswith(g.rstrip("/") + "/") for g in folders)]
    read = lambda f: f.endswith((".tsv", ".tsv.gz")) and any(f.startswith(g.rstrip("/") + "/") for g in above)
    return sorted(f for f in files if not read(f)), sorted(above)


def _utc(moment: datetime | None) -> datetime | None:
    """A moment without a zone is in UTC, as the archive's hours are."""
    return moment if moment is None or moment.tzinfo else moment.replace(tzinfo=timezone.utc)


_DAY, _HOUR = re.compile(r"\d{4}-\d{2}-\d{2}$"), re.compile(r"(\d{2})\.tsv(\.gz)?$")


def hours_within(spark: SparkSession, folder: str, since: datetime | None, until: datetime | None) -> list[str]:
    """The days' folders and hours' files below folder that can hold frames from since (inclusive) to until (exclusive).

    Folders of days out of the range aren't listed, a day that lies within it whole is one entry, and of a day at an edge
    only the hours are. So the listing grows with the range and not with the archive. Files that aren't named by day and
    hour can hold any time and are all named.
    """
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    start, end = _utc(since) or datetime.min.replace(tzinfo=timezone.utc), _utc(until) or datetime.max.replace(tzinfo=timezone.utc)
    out, todo = [], [folder]
    while todo:
        path = hadoop(todo.pop())
        for status in path.getFileSystem(conf).listStatus(path):
            name, found = status.getPath().getName(), status.getPath().toString()
            if name.startswith(("_", ".")):
                continue
            if not status.isDirectory():
                if name.endswith((".tsv", ".tsv.gz")):
                    out.append(found)
                continue
            day = _day(name)
            if day is None:
                todo.append(found)
            elif start <= day and day + timedelta(days=1) <= end:
                out.append(found)
            elif day < end and start < day + timedelta(days=1):
                for file in path.getFileSystem(conf).listStatus(status.getPath()):
                    own = file.getPath().getName()
                    hour = _HOUR.fullmatch(own)
                    begun = day + timedelta(hours=int(hour[1])) if hour else None
                    if own.endswith((".tsv", ".tsv.gz")) and (begun is None or (begun < end and start < begun + timedelta(hours=1))):
                        out.append(file.getPath().toString())
    return sorted(out)


def _day(name: str) -> datetime | None:
    if not _DAY.fullmatch(name):
        return None
    try:
        return datetime.strptime(name, "%Y-%m-%d").replace(tzinfo=timezone.utc)
    except ValueError:  # not a date after all
        return None


def _hour_of(path: str) -> Column:
    """A file's folder and its name up to the first dot. The pattern begins at the last two parts: where it may begin anywhere, its steps grow with the path's length cubed."""
    return F.regexp_extract(F.substring_index(path, "/", -2), r"^([^/]+/[^/.]+)", 1)


def _empty_lines(spark: SparkSession) -> DataFrame:
    kinds = "value string, path string, block bigint, line bigint"
    return spark.range(0).select(*(F.lit(None).cast(k.split()[1]).alias(k.split()[0]) for k in kinds.split(", ")))


def read_archive(spark: SparkSession, *paths: str, since: datetime | None = None, until: datetime | None = None, skipped: Observation | None = None) -> DataFrame:
    """seq, received_at, received_ns and payload of all lines below paths (files of any name, or folders; each file counts once).

    With since (inclusive) or until (exclusive), of the folders only the hours in that range are listed and read, and only
    frames in it are given; of each file they are those that a read of all would give.
    """
    files, folders = _files_and_folders(spark, paths)
    if since is not None or until is not None:
        within = [p for f in folders for p in hours_within(spark, f, since, until)]
        files, folders = sorted({*files, *(p for p in within if p.endswith((".tsv", ".tsv.gz")))}), [p for p in within if not p.endswith((".tsv", ".tsv.gz"))]
    parts = [spark.read.text(files)] if files else []
    if folders:
        parts.append(spark.read.text(folders, recursiveFileLookup=True, pathGlobFilter=FILES))
    parts = [p.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")) for p in parts]
    lines = parts[0].unionAll(parts[1]) if len(parts) == 2 else parts[0] if parts else _empty_lines(spark)
    rows = decoded_lines(lines, skipped=skipped)
    # a line comes when those before it in its file have come: its time is the greatest so far, split by split
    inside = Window.partitionBy("path", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    edges = rows.groupBy("path", "block").agg(F.max("received_ns").alias("most")).select("path", "block", F.max("most").over(before).alias("before"))
    rows = rows.withColumn("run_ns", F.max("received_ns").over(inside)).join(edges, ["path", "block"])
    seq = F.struct(_hour_of("path").alias("hour"), F.greatest("run_ns", "before").alias("run_ns"), "path", "block", "line")
    if since is not None or until is not None:
        # the order within a file is made before frames go
        at = F.timestamp_micros(F.expr("received_ns div 1000"))
        for bound, keep in ((_utc(since), at.__ge__), (_utc(until), at.__lt__)):
            rows = rows if bound is None else rows.where(keep(F.lit(bound)))
    return rows.select(seq.alias("seq"), F.timestamp_micros(F.expr("received_ns div 1000")).alias("received_at"), "received_ns", "payload")


def read_recording(spark: SparkSession, path: str) -> DataFrame:
    """Frames of a recording (.jsonl or .jsonl.gz), one per line; blank lines go."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("payload"))


def write_archive(raw: DataFrame, root: str, *, compressed: bool = True) -> int:
    """Add raw frames to the archive at root, and say how many files that made; read_archive() gives them back.

    An hour of a batch is a file `<root>/<batch>/YYYY-MM-DD/HH.tsv[.gz]` in the order of seq. Files are written apart and then
    moved into their place, so none is ever seen half-written; what a batch that failed left is never read.
    """
    spark = raw.sparkSession
    ns = F.col("received_ns") if "received_ns" in raw.columns else F.unix_micros("received_at") * 1000
    at = F.timestamp_micros(F.floor(ns / 1000).cast("bigint")) if "received_ns" in raw.columns else F.col("received_at")
    rows = raw.select(F.date_format(at, "yyyy-MM-dd").alias("date"), F.date_format(at, "HH").alias("hour"), *(["seq"] if "seq" in raw.columns else []), F.concat_ws("\t", ns.cast("string"), F.col("payload").cast("string")).alias("value"))
    order = ["date", "hour", *(["seq"] if "seq" in raw.columns else [])]
    batch = uuid.uuid4().hex
    staged = f"{root.rstrip('/')}/_staged-{batch}"
    rows.repartition("date", "hour").sortWithinPartitions(*order).select("date", "hour", "value").write.partitionBy("date", "hour").option("compression", "gzip" if compressed else "none").text(staged)
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    files = hadoop(staged).getFileSystem(conf)
    # one a batch and hour; Spark lists them, in parallel where they are many
    found = [(path, *_STAGED.search(path).groups()) for path in spark.read.format("text").load(staged).inputFiles()]
    for day in sorted({day for _, day, _ in found}):
        files.mkdirs(hadoop(f"{root.rstrip('/')}/{batch}/{day}"))

    def moved(path: str, day: str, hour: str) -> None:
        if not files.rename(hadoop(unquote(path)), hadoop(f"{root.rstrip('/')}/{batch}/{day}/{hour}.tsv{'.gz' if compressed else ''}")):
            raise OSError(f"{path} can't be moved into its place")

    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda file: moved(*file), found))
    files.delete(hadoop(staged), True)
    return len(found)


def write_recording(raw: DataFrame, path: str) -> None:
    """Frames as lines of text, as read_recording() reads them."""
    raw.select("payload").write.mode("append").text(path)
