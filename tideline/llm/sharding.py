"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in parts: those of a partition, PART at most. The matrix says how many rows go from every part to every shard: its
rows sum to the parts, its columns to the shards, and it is distributed as in a uniform permutation of all rows. It is drawn
as a tree: a node's rows per shard are dealt to its children, one after the other, each from what the ones before left
(multivariate hypergeometric), in groups of 2**FAN children at most; what a node's elder siblings took is the place where
its rows begin in each shard. So no task holds more than one group, and the driver holds the shards' sizes only.

Then every part permutes its rows (a permutation drawn for it), its first rows go to the first shard, and so on; the rows
are exchanged by ranges of slots, shard after shard and all of one size, and permuted again within the shard by a keyed
bijection of its slots (a Feistel network, walked until it falls inside the shard). That needs no second exchange and no task that holds a shard. Every draw
is keyed by the seed and the part or node, so a task that runs again draws the same; the input's rows are written with
their parts first.

Sizes: counts of shards differ by one at most, as the first of them take what is left over. Repeated rows and equal texts
are rows of their own, dealt like all others. Nulls in any column are kept. Very long texts are only carried. An empty table
gives no rows; fewer rows than shards leave shards empty. The columns shard and slot of the input, if there are such, are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import arrow_bounds, lean, settled, table, text_or_empty

#: log2 of the rows of a part at most, and of the children of a node at most. A partition number and a row's place in it are 31 and 33 bits.
PART, FAN = 20, 13
#: Up to so many counts the matrix is broadcast (8 bytes each), else rows are dealt by part to meet it.
BROADCAST_COUNTS = 1_000_000
#: Bytes of the stored (compressed) rows that are exchanged together, about.
EXCHANGED = 32 << 20
ROUNDS = 8


def hypergeometric(rng: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """How many of taken draws without return are good. The weights come from ratios of neighbours around the mode, over all values within 12 deviations and 64 (beyond lie less than 1e-30)."""
    low, high = max(0, taken - bad), min(taken, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (taken + 1) * (good + 1) // (total + 2)))
    p = good / total
    reach = int(12 * np.sqrt(taken * p * (1 - p) * (total - taken) / max(total - 1, 1))) + 64
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    # weight(k + 1) / weight(k)
    ratios = (good - k) * (taken - k) / ((k + 1) * (bad - taken + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(np.log(ratios))])
    upto = np.cumsum(np.exp(logs - logs[mode - low]))
    return low + int(np.searchsorted(upto, rng.random() * upto[-1], side="right").clip(0, high - low))


def dealt(rng: np.random.Generator, left: list[int], taken: int) -> list[int]:
    """How many of taken draws fall to each shard, of which so many are left."""
    out, rest = [], sum(left)
    for n in left:
        got = hypergeometric(rng, n, rest - n, taken)
        out.append(got)
        rest, taken = rest - n, taken - got
    return out


def sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def _children(level: int, seed: int):
    """The rows of the matrix for a node's children, from the node's own."""
    schema = pa.schema([("node", pa.int64()), ("counts", pa.list_(pa.int64())), ("begins", pa.list_(pa.int64()))])

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["node"])
        left, begins, out = list(rows[0]["counts"]), list(rows[0]["begins"]), []
        rng = np.random.default_rng([seed, level, rows[0]["above"]])
        for r in rows:
            counts = dealt(rng, left, r["rows"])
            out.append({"node": r["node"], "counts": counts, "begins": begins})
            left = [a - b for a, b in zip(left, counts, strict=True)]
            begins = [a + b for a, b in zip(begins, counts, strict=True)]
        return pa.Table.from_pylist(out, schema=schema)

    return run


def communication_matrix(parts: DataFrame, shards: list[int], seed: int) -> DataFrame:
    """part, counts and begins (a number for each shard) of parts (part, rows) whose rows sum to those of the shards."""
    spark, levels, shift = parts.sparkSession, [parts.select(F.col("part").alias("node"), "rows")], 0
    top = parts.agg(F.max("part")).first()[0] or 0
    while top >> shift:
        shift += FAN
        levels.append(settled(levels[-1].groupBy(F.shiftright("node", FAN).alias("node")).agg(F.sum("rows").alias("rows")), "shards-level"))
    known = spark.range(1).select(F.lit(0).cast("bigint").alias("node"), *(F.array(*(F.lit(v).cast("bigint") for v in vs)).alias(c) for c, vs in (("counts", shards), ("begins", [0] * len(shards)))))
    for level in range(len(levels) - 2, -1, -1):
        above = levels[level].withColumn("above", F.shiftright("node", FAN)).join(known.withColumnRenamed("node", "above"), "above")
        known = settled(above.groupBy("above").applyInArrow(_children(level, seed), "node bigint, counts array<bigint>, begins array<bigint>"), "shards-matrix")
    return known.withColumnRenamed("node", "part")


def _mixed(x: np.ndarray, key: np.uint64) -> np.ndarray:
    """A hash of whole numbers (splitmix64's finaliser)."""
    z = x + key
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def bijection(places: np.ndarray, size: int, seed: int, shard: int) -> np.ndarray:
    """The images of places under a keyed permutation of 0 to size - 1."""
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.random.default_rng([seed, 1 << 40, shard, size]).integers(0, 1 << 64, ROUNDS, np.uint64)
    out, todo = places.astype(np.uint64), np.arange(len(places))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for key in keys:
            left, right = right, left ^ (_mixed(right, key) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _placed(names: list[str], totals: list[int], seed: int, bits: int):
    """Shard and slot of rows, by their part's row of the matrix and their place in the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = order = upto = begins = None
        for b in batches:
            at = b.column("__at").to_numpy()
            parts = at >> bits
            shard, slot = np.empty(len(at), np.int32), np.empty(len(at), np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(at)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if parts[s] != now:
                    now = parts[s]
                    counts, begins = (np.array(b.column(c)[s].as_py(), np.int64) for c in ("counts", "begins"))
                    upto = np.cumsum(counts)
                    order = np.random.default_rng([seed, 1 << 41, int(now)]).permutation(int(upto[-1]))
                place = order[at[s:e] & ((1 << bits) - 1)]
                to = np.searchsorted(upto, place, side="right")
                shard[s:e] = to
                slot[s:e] = begins[to] + place - np.concatenate([[0], upto])[to]
            for j in np.unique(shard).tolist():
                mine = np.flatnonzero(shard == j)
                slot[mine] = bijection(slot[mine], totals[j], seed, j)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(shard), pa.array(slot)], names=[*names, "shard", "slot"])

    return run


def shuffled(df: DataFrame, shards: int, *, seed: int = 0) -> DataFrame:
    """df with shard and slot, a uniform shuffle; rows of a range of slots lie in one partition, in order of slots."""
    spark = df.sparkSession
    arrow_bounds(spark)
    own = df.drop("shard", "slot")
    names = own.columns
    # the number of a row: its partition and its place in that
    rows = settled(own.withColumn("__at", F.monotonically_increasing_id()), "shards-rows")
    parts = settled(rows.groupBy(F.shiftright("__at", PART).alias("part")).agg(F.count("*").alias("rows")), "shards-parts")
    total, many = parts.agg(F.sum("rows"), F.count("*")).first()
    totals = sizes(total or 0, shards)
    matrix = communication_matrix(parts, totals, seed)
    if many * shards * 2 <= BROADCAST_COUNTS:
        matrix = F.broadcast(matrix)
    met = rows.withColumn("__part", F.shiftright("__at", PART)).join(matrix.withColumnRenamed("part", "__part"), "__part")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema), "shard int", "slot bigint"])
    placed = met.select(*names, "__at", "counts", "begins").mapInArrow(lean(_placed(names, totals, seed, PART)), schema)
    stored = rows.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored // EXCHANGED))
    # equal ranges of all slots, shard after shard
    begins = F.array(*(F.lit(sum(totals[:i])).cast("bigint") for i in range(shards)))
    place = (F.get(begins, F.col("shard")) + F.col("slot")).cast("decimal(20,0)")
    return placed.repartitionById(ranges, F.floor(place * ranges / max(total or 0, 1)).cast("int")).sortWithinPartitions("shard", "slot")


def write_shards(df: DataFrame, path: str, shards: int, *, seed: int = 0) -> None:
    """Write df, shuffled, as a Parquet table with a folder for each shard; files hold ranges of slots in order."""
    shuffled(df, shards, seed=seed).write.partitionBy("shard").parquet(path)


#: The shards of the query.
SHARDS = 40


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' places in a uniform shuffle into 40 shards whose counts differ by one at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = text_or_empty()
    # the digests are those of the rows that were exchanged
    return shuffled(docs, SHARDS).select(
        "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
