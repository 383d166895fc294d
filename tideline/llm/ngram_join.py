"""N-gram Jaccard join: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

1. Each text gets the digest of its set of shingles and HASHES MinHash values: bands of ROWS whole values as keys, and
   one byte of each value to compare. Texts with equal sets are one node from here on, with their number as its weight.
2. Nodes with an equal band key are candidates. A text pair at the threshold shares none of the BANDS keys with
   probability (1 - 0.8 ** ROWS) ** BANDS, about 3e-6; closer pairs far less. In a bucket, rows pass by once, in order:
   each is compared with the bucket's leaders, and is a new leader unless one differs from it in at most CLOSE of the HASHES
   bytes. It is linked with every leader that differs in at most CLOSE + D, where D is what a pair at the threshold may differ
   in. Differing bytes are a metric, so of two rows that differ in at most D the second is linked with the first's leader:
   no bucket makes all its pairs, and none of these is lost. Buckets over SALT rows are split, with leaders for SPLIT_CLOSE
   bytes; their parts' leaders meet in a second pass that links what differs in at most D + 3 * SPLIT_CLOSE.
3. Comparing means Bayesian pruning: after each CHECK more MinHash bytes, a pair is dropped if the posterior probability
   (uniform prior) that its similarity reaches what is asked is below TOLERANCE.
4. Components of these links are small but for groups of near copies. Each is cut into blocks of about BLOCK nodes (fewer
   where sets are large), and
   each two blocks of a component meet in one task: all their pairs are pruned as above at the threshold, and the rest are
   verified on the whole sets. A node leaves one row per block: how many texts it is linked with, and the least node that
   it hangs together with. Pairs are never written.

Words are runs of ASCII letters, digits and non-ASCII characters after A-Z are lower-cased; a text of fewer than five
words is one shingle. Texts without words (nulls too) are linked with nothing. Very long texts take
part with all their shingles. All rows stay, repeated rows too: equal
texts are linked copies. A null doc_id takes part but names no class unless all ids of a class are null. Columns besides
id and text are not read; an empty table gives an empty result. Ties in order are broken by the digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import arrow_bounds, held, lean, met, settled, table, text_or_empty
from tideline.llm.components import components
from tideline.llm.decontaminate import words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
CHECK = 32
TOLERANCE = 1e-6
SALT = 1024
CLOSE, SPLIT_CLOSE = 32, 12
#: Nodes of a block at most, and about how many shingles their sets have at most.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Nodes to verify up to which their (short) rows are broadcast to the documents.
BROADCAST_ROWS = 100_000
_ODD = (np.random.default_rng(20240229).integers(1, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_MIX = np.random.default_rng(5).integers(1, 1 << 63, max(ROWS, SHINGLE), dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def _hashes() -> _Hashes:
    return held(("hashes",), _Hashes)


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The hashes of the text's distinct shingles, rising."""
    own = words(text)
    if not own:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes().__getitem__, own), np.uint64, len(own))
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(size, len(h))):
        out = _mixed(out + h[i : i + n] * _MIX[i])
    return np.unique(out)


def minhashes(x: np.ndarray) -> np.ndarray:
    """MinHash values of a set that isn't empty, in parts of bounded size."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), 512):
        np.minimum(out, (x[at : at + 512, None] * _ODD).min(axis=0), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i, column in enumerate(values.reshape(BANDS, ROWS).T):
        key = _mixed(key + column * _MIX[i])
    return key.view(np.int64)


@cache
def least_matches(similarity: float) -> tuple[int, ...]:
    """By checks of CHECK hashes: the fewest equal bytes at which the posterior still reaches TOLERANCE.

    With a uniform prior on the share p of equal bytes, P(p >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    t = similarity + (1 - similarity) / 256
    out = []
    for n in range(CHECK, HASHES + 1, CHECK):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= TOLERANCE:
                out.append(m)
                break
    return tuple(out)


def may_reach(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether rows of a and b (broadcast against each other) stay after all checks."""
    shape = np.broadcast_shapes(a.shape, b.shape)[:-1]
    left = np.ones(shape, bool)
    equal = np.zeros(shape, np.int16)
    for i, least in enumerate(least_matches(similarity)):
        part = slice(i * CHECK, (i + 1) * CHECK)
        if i < 2 or left.mean() > 0.5:
            equal = equal + (a[..., part] == b[..., part]).sum(axis=-1, dtype=np.int16)
            left &= equal >= least
        else:
            at = np.nonzero(left)
            u, v = np.broadcast_to(a, (*shape, HASHES)), np.broadcast_to(b, (*shape, HASHES))
            equal[at] += (u[(*at, part)] == v[(*at, part)]).sum(axis=-1, dtype=np.int16)
            left[at] = equal[at] >= least
        if not left.any():
            break
    return left


SIGNED = "doc_id bigint, node binary, n bigint, signature binary, bands array<bigint>"


def signed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", key: str | None = None) -> DataFrame:
    """SIGNED, and key, a further column, as text."""
    arrow_bounds(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, sizes, signatures, bands = [], [], [], []
            for t in b.column(1).to_pylist():
                x = shingles(t)
                nodes.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                sizes.append(len(x))
                if len(x):
                    m = minhashes(x)
                    signatures.append((m >> np.uint64(40)).astype(np.uint8).tobytes())
                    bands.append(band_keys(m))
                else:
                    signatures.append(b"")
                    bands.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(bands, pa.list_(pa.int64())), *b.columns[2:]], names=["doc_id", "node", "n", "signature", "bands", *b.schema.names[2:]])

    further = [F.col(key).cast("string").alias("key")] if key else []
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).cast("binary").alias("text"), *further).mapInArrow(lean(run), SIGNED + (", key string" if key else ""))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


class _Bucket:
    """The leaders of one bucket, as rows pass by."""

    def __init__(self, key):
        self.key, self.nodes, self.rows, self.up = key, [], np.empty((4, HASHES), np.uint8), []

    def table(self) -> np.ndarray:
        return self.rows[: len(self.nodes)]

    def top(self, i: int) -> int:
        while self.up[i] != i:
            i = self.up[i]
        return i

    def links(self, hit: list[int], node: bytes) -> Iterator[tuple[bytes, bytes]]:
        """Links that join node and these leaders, but for those that are joined already: at most one a row, and one a leader in all."""
        first = self.top(hit[0])
        yield self.nodes[first], node
        for k in hit[1:]:
            k = self.top(k)
            if k != first:
                first, k = min(first, k), max(first, k)
                self.up[k] = first
                yield self.nodes[first], self.nodes[k]

    def lead(self, node: bytes, row: np.ndarray) -> None:
        if len(self.nodes) == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[len(self.nodes)] = row
        self.up.append(len(self.nodes))
        self.nodes.append(node)


@cache
def _within(differing: int) -> float:
    """A similarity whose pruning keeps pairs that differ in so many of all bytes."""
    return max(k / 100 for k in range(1, 100) if least_matches(k / 100)[-1] <= HASHES - differing)


def _linked(close: tuple[int, int], far: tuple[int, int]):
    """Rows key, [salt,] node, signature sorted by key: gives key, a, b of links (a leader's with itself too).

    close and far: in how many bytes a row may differ from its leader, and from leaders that it is linked with; the second
    of each where salt is at least 0, or isn't there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = _Bucket(None)
        for batch in batches:
            keys = list(zip(*(c.to_pylist() for c in batch.columns[:-2]), strict=True))
            nodes, rows = batch.column(batch.num_columns - 2).to_pylist(), _matrix(batch.column(batch.num_columns - 1))
            # most buckets have two rows: compare all neighbours in the batch at once
            same = np.zeros(len(keys), bool)
            if len(keys) > 1:
                same[1:] = (rows[1:] != rows[:-1]).sum(axis=1) <= min(close)
            out_key, out_a, out_b = [], [], []
            for i, key in enumerate(keys):
                split = len(key) == 1 or key[1] >= 0
                if key != bucket.key:
                    bucket, first = _Bucket(key), i
                    bucket.lead(nodes[i], rows[i])
                    out_key.append(key), out_a.append(nodes[i]), out_b.append(nodes[i])
                    continue
                if len(bucket.nodes) == 1 and i == first + 1 and same[i] and keys[i - 1] == key:
                    hit, near = [0], True
                else:
                    hit = np.flatnonzero(may_reach(bucket.table(), rows[i], _within(far[split])))
                    near = bool(len(hit)) and bool(((bucket.table()[hit] != rows[i]).sum(axis=1) <= close[split]).any())
                for a, b in bucket.links(list(hit), nodes[i]) if len(hit) else ():
                    out_key.append(key), out_a.append(a), out_b.append(b)
                if not near:
                    bucket.lead(nodes[i], rows[i])
                    if len(hit):
                        bucket.up[-1] = bucket.top(hit[0])
                    out_key.append(key), out_a.append(nodes[i]), out_b.append(nodes[i])
            first = -2  # a bucket that goes on in the next batch is compared there in full
            yield pa.RecordBatch.from_arrays([*(pa.array([k[j] for k in out_key], batch.column(j).type) for j in range(batch.num_columns - 2)), pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], names=[*batch.schema.names[:-2], "a", "b"])

    return run


def candidate_links(nodes: DataFrame) -> DataFrame:
    """Links a, b (with a <> b) between nodes that share a bucket and can't be told apart from near ones."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.select("node", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    kept = rows.join(sizes, "key").withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / SALT)).cast("int"))
    kept = kept.withColumn("salt", F.when(F.col("size") > SALT, F.col("salt")).otherwise(-1))
    full = kept.join(nodes.select("node", "signature"), "node").select("key", "salt", "node", "signature")
    dealt = full.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "node")
    d = HASHES - least_matches(THRESHOLD)[-1]
    arrow_bounds(spark)
    first = settled(dealt.mapInArrow(lean(_linked((CLOSE, SPLIT_CLOSE), (d + CLOSE, d + SPLIT_CLOSE))), "key bigint, salt int, a binary, b binary").where("salt >= 0 or a <> b"), "op2-links")
    leaders = first.where("salt >= 0 and a = b").select("key", F.col("a").alias("node")).join(nodes.select("node", "signature"), "node").select("key", "node", "signature")
    again = leaders.repartition(parts, "key").sortWithinPartitions("key", "node").mapInArrow(lean(_linked((SPLIT_CLOSE,) * 2, (d + 3 * SPLIT_CLOSE,) * 2)), "key bigint, a binary, b binary")
    links = first.select("a", "b").where("a <> b").unionAll(again.select("a", "b").where("a <> b")).distinct()
    # a leader comes before its rows: a < b, and a node has at most 2 * BANDS leaders. Each node keeps its least leader, and
    # its other leaders are linked with that one; as links repeat from bucket to bucket, few are left, and all hangs together
    least = links.select("a", "b", F.min("a").over(Window.partitionBy("b")).alias("least"))
    least = settled(least, "op2-least")
    own, other = least.select(F.col("least").alias("a"), "b"), least.select(F.col("least").alias("a"), F.col("a").alias("b"))
    return own.unionAll(other).where("a <> b").distinct()


class _Sets:
    """Union by the least member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.top(i), self.top(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles the sets left[k] and right[k] share."""
    if len(left) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left.tolist(), right.tolist(), strict=True)], np.int64)
    sizes = [len(s) for s in sets]
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    common, width = np.zeros((len(sets), len(sets)), np.float32), 4096
    for at in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, [at, at + width])
        x = np.zeros((len(sets), width), np.float32)
        x[row[a:b], column[a:b] - at] = 1
        common += x @ x.T  # whole numbers below 2 ** 24
    return common[left, right].astype(np.int64)


def _verify(i: int, j: int, blocks: np.ndarray, nodes: list[bytes], weights: np.ndarray, rows: np.ndarray, sets: list[np.ndarray]) -> list[tuple[bytes, int, bytes]]:
    sizes = np.array([len(s) for s in sets])
    joined, links = _Sets(len(nodes)), np.zeros(len(nodes), np.int64)
    order, pairs = np.arange(len(nodes)), []
    for a in range(len(nodes)):
        if i == j:
            b = order[a + 1 :]
        elif blocks[a] == i:
            b = order[blocks == j]
        else:
            continue
        b = b[np.minimum(sizes[b], sizes[a]) >= THRESHOLD * np.maximum(sizes[b], sizes[a]) - 1e-9]
        if len(b):
            b = b[may_reach(rows[b], rows[a], THRESHOLD)]
        pairs.append(np.stack([np.full(len(b), a, np.int64), b]))
    left, right = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), np.int64)
    if len(left):
        shared = _shared(sets, left, right)
        near = 10 * shared >= 8 * (sizes[left] + sizes[right] - shared)
        for a, b in zip(left[near].tolist(), right[near].tolist(), strict=True):
            joined.join(a, b)
            links[a] += weights[b]
            links[b] += weights[a]
    return [(nodes[k], int(links[k]), nodes[joined.top(k)]) for k in range(len(nodes)) if links[k]]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows comp, i, j, block, node, weight, signature, set sorted by comp, i, j: one group is held at a time."""
    key, held = None, []

    def done():
        if not held:
            return []
        held.sort(key=lambda r: r[4])
        return _verify(key[1], key[2], np.array([r[3] for r in held]), [r[4] for r in held], np.array([r[5] for r in held], np.int64), np.frombuffer(b"".join(r[6] for r in held), np.uint8).reshape(-1, HASHES), [np.frombuffer(r[7], np.uint64) for r in held])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["node", "links", "root"])

    for b in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[:3] != key:
                out += done()
                key, held = row[:3], []
            held.append(row)
        yield batch(out)
    yield batch(done())


def verified(docs: DataFrame, nodes: DataFrame, comps: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """node, links (texts it is linked with) and root, a row for each block that it has links in."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    all_nodes = comps.join(nodes.select("node", "doc", "weight", "signature", "n"), "node")
    sizes = all_nodes.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    all_nodes = settled(all_nodes, "op2-all")
    wanted = met(all_nodes, settled(sizes, "op2-sizes"), "label").select("node", F.col("label").alias("comp"), "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), "doc", "weight", "signature")
    wanted = settled(wanted, "op2-wanted")
    short = wanted.select(F.col("doc").alias("__doc"), "node")
    few = wanted.count() <= BROADCAST_ROWS
    own = docs.select(F.col(doc_id).cast("bigint").alias("__doc"), text_or_empty(text).cast("binary").alias("__text"))
    joined = own.join(F.broadcast(short) if few else short, own["__doc"].eqNullSafe(short["__doc"])).select("node", "__text")
    arrow_bounds(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for node, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = shingles(t).tobytes()
                if hashlib.blake2b(x, digest_size=16).digest() == node:  # else another text with this id
                    out.append((node, x))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.binary())], names=["node", "set"])

    sets = joined.mapInArrow(lean(run), "node binary, set binary").dropDuplicates(["node"])
    full = wanted.join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    full = full.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "weight", "signature", "set")
    dealt = full.repartition(parts, "comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    return dealt.mapInArrow(lean(_blocks), "node binary, links bigint, root binary")


def joined(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id (the least id that the text hangs together with through links) and n_links, a row per text."""
    return classed(docs, doc_id=doc_id, text=text).select("doc_id", "class_id", "n_links")


def classed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", key: str | None = None) -> DataFrame:
    """The columns of joined(), label (of the text's class, null for a text without words), and key where a column is named."""
    rows = settled(signed(docs, doc_id=doc_id, text=text, key=key), "op2-rows")
    nodes = settled(rows.where("n > 0").groupBy("node").agg(F.count("*").alias("weight"), F.min("doc_id").alias("doc"), F.first("signature").alias("signature"), F.first("bands").alias("bands"), F.first("n").alias("n")), "op2-nodes")
    comps = components(candidate_links(nodes))
    found = settled(verified(docs, nodes, comps, doc_id=doc_id, text=text), "op2-found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    own = nodes.select("node", "weight", "doc").join(links, "node", "left").join(classes, "node", "left").select("node", "doc", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "node").alias("label"))
    own = settled(own, "op2-own")
    least = own.groupBy("label").agg(F.min("doc").alias("class_id"))
    known = met(own, settled(least, "op2-least"), "label").select("node", "label", "class_id", "n_links")
    further = ["key"] if key else []
    some, none = rows.where("n > 0").select("doc_id", "node", *further), rows.where("n = 0")
    wordless = none.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(None).cast("binary").alias("label"), *further)
    return some.join(known, "node").select("doc_id", "class_id", "n_links", "label", *further).unionAll(wordless)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies and its number of links."""
    return joined(table(spark, sf_dir, "documents"))


#: Exact sets, all pairs that share a shingle, and classes by walking along links: for small tables.
OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT k, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT k, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT k, count(*) AS n FROM s GROUP BY k),
p AS (SELECT a.k AS x, b.k AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.k <> b.k GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n u ON u.k = x JOIN n v ON v.k = y WHERE 10 * c >= 8 * (u.n + v.n - c)),
r(k, t) AS (SELECT k, k FROM n UNION SELECT r.k, l.y FROM r JOIN l ON r.t = l.x),
m AS (SELECT r.k, min(d.doc_id) AS class_id FROM r JOIN d ON d.k = r.t GROUP BY r.k),
c AS (SELECT x AS k, count(*) AS n_links FROM l GROUP BY x)
SELECT doc_id, CASE WHEN len(w) > 0 THEN class_id ELSE doc_id END AS class_id, coalesce(n_links, 0) AS n_links FROM d LEFT JOIN m USING (k) LEFT JOIN c USING (k)
"""
