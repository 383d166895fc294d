"""The trie of conversations' prefixes, from the Cartesian tree over the LCP array of the sorted conversations.

Conversations are cut into pieces of WIDTH turns; a piece is known by its place and a digest of all turns before it, so that
no row holds more than WIDTH turns however long a conversation is. A conversation of n turns has n div WIDTH + 1 pieces, the
last with less than WIDTH turns, maybe none. All pieces are sorted at once (place, digest before, turns, conversation), in
range partitions, and written in blocks of BLOCK rows with their LCP array: how many turns a row shares with the row before
it, -1 where place or digest differ.

An LCP value is nearest smaller to the left and to the right of some positions; between those lie the rows that share so
many turns: a node of the Cartesian tree. All-nearest-smaller-values are found with a stack inside a block. What isn't
closed inside a block is at most WIDTH + 1 levels on either side, and goes by the blocks' minima: for each level, the next
and the last position with a smaller value beyond the block, a window over blocks and not over rows. Positions of equal
value between the same bounds are merged to one node, depths that no LCP value names are expanded from the nodes above and
below, and members are aggregated over intervals: least conversation, terminal rows (leaves) and saved bytes by prefix sums
inside a block, and by sums of one row per block and open level across blocks. Depth 0 of a later piece is the last depth of
the piece before.

Turns are compared by 128 bits of their SHA-256, prefixes of whole pieces by 120. Equal turns have the same role and text.
Turns with equal numbers are ordered by the SHA-256 of role and text; repeated rows are turns of their own. Rows without a
conv_id belong to no conversation. Null roles and texts are empty, null turns come first. A very long text is read once and
counts by its digest and length; a very long conversation is many pieces. An empty table has no nodes, not even a root.
Columns of the input other than those named are not read; clashing names do no harm.

The digest of the members that end at a node is the digest of one string, so the ids of one node are hashed in order by one
task; it holds a block's ids at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions.running import numbered, pieced
from tideline.llm.common import arrow_bounds, lean, settled, table, text_or_empty

#: Turns of a piece at most, rows of a block at most.
WIDTH, BLOCK = 64, 16_384
#: Turns of a conversation that meet one row of the table of conversations.
CELL = 4096
#: Turns that are numbered in one range.
ROWS = 50_000
#: The number of a conversation's head turns is below this.
HEADS = 9

BLOCKS = "part int, number int, n int, head array<binary>, head_at array<bigint>, tail array<binary>, tail_at array<bigint>, lcp binary, size binary, chunk binary, conv binary, weights binary, long boolean"
LEVELS = "block bigint, lcp0 int, last int, first_at array<int>, last_at array<int>"
PARTS = "block bigint, pos bigint, d int, low bigint, saved bigint, leaves bigint, kids bigint, ended array<bigint>"
LONG = "block bigint, row int, conv_id bigint, chunk bigint, saved bigint, leaves bigint, last_pos bigint"
NODES = "pos bigint, d int, chunk bigint, member bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
NOBODY = hashlib.sha256(b"").hexdigest()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in list(kinds.items())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


# ---- rebuilt conversations


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its five."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 0), digest and bytes of the turns of every conversation after its head was replaced; one more row, without digest, at each end.

    Heads meet at most HEADS - 1 turns of the first conversation of their five. A conversation's turns meet its length in
    cells of CELL turns, so a hot one is dealt over many tasks.
    """
    who, said = text_or_empty(role), text_or_empty(text)
    digest = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256))
    own = conversations.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(said).cast("bigint").alias("bytes")).where("conv_id is not null")
    own = settled(own.select("conv_id", "digest", "bytes", F.struct("turn", "digest").alias("along")), "trie-turns")
    turns = settled(numbered(pieced(own, "conv_id", "along", rows=ROWS), ["conv_id"], "along", "n").select("conv_id", (F.col("n") - 1).alias("n"), F.substring("digest", 1, 16).alias("digest"), "bytes"), "trie-numbered")
    many = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("h", head_turns(F.col("conv_id"))).withColumn("base", F.expr("conv_id - conv_id % 5"))
    many = many.alias("c").join(many.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left")
    many = settled(many.select("conv_id", "base", "own", "h", F.least("h", F.coalesce("there", F.lit(0))).cast("bigint").alias("taken")), "trie-conversations")
    first = turns.where(F.col("n") < HEADS - 1).withColumnRenamed("conv_id", "base")
    heads = first.join(many.select("conv_id", "base", "h"), "base").where("n < h").select("conv_id", F.col("n").alias("place"), "digest", "bytes")
    cells = many.select("conv_id", "h", "taken", F.explode(F.expr(f"sequence(0L, own div {CELL})")).alias("cell"))
    rest = turns.withColumn("cell", F.expr(f"n div {CELL}")).join(cells, ["conv_id", "cell"]).where("n >= h")
    rest = rest.select("conv_id", (F.col("n") - F.col("h") + F.col("taken")).alias("place"), "digest", "bytes")
    ends = many.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("bigint").alias("bytes"))
    return heads.unionByName(rest).unionByName(ends)


def pieces(turns: DataFrame, width: int) -> DataFrame:
    """conv_id, chunk (its place), p1 and p2 (the digest of all before), symbols (digests of at most width turns) and weights (bytes of the turn before the piece and of its turns)."""
    at = F.expr(f"place div {width}")
    last = F.expr(f"place % {width} = {width - 1} and digest is not null")
    here = F.struct(at.alias("chunk"), F.expr(f"place % {width}").alias("i"))
    ahead = F.struct((at + 1).alias("chunk"), F.lit(-1).cast("bigint").alias("i"))
    cells = turns.select("conv_id", "digest", "bytes", F.explode(F.when(last, F.array(here, ahead)).otherwise(F.array(here))).alias("x"))
    cells = cells.select("conv_id", "x.chunk", F.struct("x.i", "digest", "bytes").alias("cell")).groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    own = F.filter("cells", lambda x: (x["i"] >= 0) & x["digest"].isNotNull())
    before = F.coalesce(F.get(F.filter("cells", lambda x: x["i"] < 0), F.lit(0))["bytes"], F.lit(0).cast("bigint"))
    cells = cells.select("conv_id", "chunk", F.transform(own, lambda x: x["digest"]).alias("symbols"), F.concat(F.array(before), F.transform(own, lambda x: x["bytes"])).alias("weights"))
    cells = settled(cells, "trie-pieces")
    # only conversations of width turns or more have pieces to hash: the sums go over pieces, not turns
    of_long = (F.col("chunk") > 0) | (F.size("symbols") == width)
    text = F.sha2(F.concat(F.col("chunk").cast("string").cast("binary"), F.array_join(F.transform("symbols", F.hex), "").cast("binary")), 256)
    along = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    digits = [F.conv(F.substring(text, s, 15), 16, 10).cast("bigint") for s in (1, 16)]
    hashed = [F.coalesce(F.bit_xor(f"d{i}").over(along), F.lit(0).cast("bigint")).alias(f"p{i}") for i in (1, 2)]
    names = ["conv_id", "chunk", "symbols", "weights"]
    late = cells.where(of_long).select(*names, digits[0].alias("d1"), digits[1].alias("d2")).select(*names, *hashed)
    nought = F.lit(0).cast("bigint")
    return late.unionByName(cells.where(~of_long).select(*names, nought.alias("p1"), nought.alias("p2")))


# ---- blocks of the sorted pieces


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Digests as pairs of numbers, and how many each row has."""
    flat = lists.flatten().cast(pa.binary(16))
    raw = np.frombuffer(flat.buffers()[1] or b"", "<u8", 2 * len(flat), 16 * flat.offset).reshape(-1, 2)
    return raw, np.diff(lists.offsets.to_numpy()).astype(np.int64)


def common(left: np.ndarray, at: np.ndarray, right: np.ndarray, to: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many entries from left[at] and right[to] on are equal, at most most."""
    n, alive, d = np.zeros(len(at), np.int64), np.flatnonzero(most > 0), 0
    while len(alive):
        alive = alive[(left[at[alive] + d] == right[to[alive] + d]).all(axis=1)]
        d += 1
        n[alive] = d
        alive = alive[most[alive] > d]
    return n


def _blocked(width: int, block: int):
    schema = _schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, before = TaskContext.get().partitionId(), 0, [], None

        def cut(rows: list, n: int):
            keys = np.concatenate([r[0] for r in rows])
            size, lcp, conv = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
            raw, weights = np.concatenate([r[4] for r in rows]), np.concatenate([r[5] for r in rows])
            upto = np.concatenate([[0], np.cumsum(size)])
            wide = np.concatenate([[0], np.cumsum(size + 1)])
            mine, rest = slice(0, n), slice(n, None)

            def edge(i: int):
                return [x.tobytes() for x in raw[upto[i] : upto[i + 1]]], keys[i].tolist()

            (head, head_at), (tail, tail_at) = edge(0), edge(n - 1)
            chunk = keys[mine, 0]
            values = [part, number, n, head, head_at, tail, tail_at, lcp[mine].astype("<i2").tobytes(), size[mine].astype("<i2").tobytes(), chunk.astype("<i8").tobytes(), conv[mine].astype("<i8").tobytes(), weights[: wide[n]].astype("<i8").tobytes(), bool(((chunk > 0) | (size[mine] == width)).any())]
            row = pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)
            return row, [(keys[rest], size[rest], lcp[rest], conv[rest], raw[upto[n] :], weights[wide[n] :])]

        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1).astype(np.int64)
            raw, size = _flat(b.column(3))
            upto = np.concatenate([[0], np.cumsum(size)])
            lcp = np.full(len(size), -1, np.int64)
            same = np.flatnonzero((keys[1:] == keys[:-1]).all(axis=1)) + 1
            lcp[same] = common(raw, upto[same - 1], raw, upto[same], np.minimum(size[same - 1], size[same]))
            if before is None:
                lcp[0] = -2  # the row before it is another task's
            elif (before[0] == keys[0]).all():
                lcp[0] = common(before[1], np.array([0]), raw, np.array([0]), np.array([min(len(before[1]), size[0])]))[0]
            before = keys[-1], raw[upto[-2] :].copy()
            held.append((keys, size, lcp, b.column(5).to_numpy(zero_copy_only=False), raw, b.column(4).flatten().to_numpy(zero_copy_only=False)))
            while sum(len(r[1]) for r in held) >= block:
                row, held = cut(held, block)
                number += 1
                yield row
        left = sum(len(r[1]) for r in held)
        if left:
            yield cut(held, left)[0]

    return run


def sorted_blocks(rows: DataFrame, width: int, block: int) -> DataFrame:
    """The sorted pieces in blocks, numbered along the order, each with start, the number of rows before it, and the end of the block before."""
    spark = rows.sparkSession
    order = ["chunk", "p1", "p2", "symbols", "conv_id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    along = rows.select("chunk", "p1", "p2", "symbols", "weights", "conv_id").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    made = settled(along.mapInArrow(lean(_blocked(width, block)), BLOCKS), "trie-blocks")
    # a row per range partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = made.groupBy("part").agg(F.count("*").alias("b"), F.sum("n").alias("r"))
    counts = counts.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).cast("bigint").alias(f"{c}0") for c in "br"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    places = made.select("part", "number", "tail", "tail_at", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("r")).join(counts, "part")
    places = settled(places.select("part", "number", "tail", "tail_at", (F.col("number") + F.col("b0")).alias("block"), (F.col("r") + F.col("r0")).alias("start")), "trie-places")
    edges = places.select((F.col("block") + 1).alias("block"), F.col("tail").alias("before"), F.col("tail_at").alias("before_at"))
    placed = made.drop("tail", "tail_at").join(places.select("part", "number", "block", "start"), ["part", "number"]).join(edges, "block", "left")
    return settled(placed, "trie-placed")


def _levels(width: int):
    """For every level up to width, the first and the last position of a block whose LCP is smaller."""
    schema = _schema(LEVELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                lcp = np.frombuffer(r["lcp"], "<i2").astype(np.int64)
                if lcp[0] == -2:
                    same = r["before_at"] is not None and r["before_at"] == r["head_at"]
                    lcp[0] = -1
                    while same and lcp[0] + 1 < min(len(r["before"]), len(r["head"])) and r["before"][lcp[0] + 1] == r["head"][lcp[0] + 1]:
                        lcp[0] += 1
                    lcp[0] += same
                # the running minimum from either side names the positions; block minima are its ends
                first, last = np.full(width + 1, -1), np.full(width + 1, -1)
                for side, forward in ((first, True), (last, False)):
                    values = lcp if forward else lcp[::-1]
                    low = np.minimum.accumulate(values)
                    for v in range(width + 1):
                        i = int(np.searchsorted(-low, -v, side="right"))  # low falls: the first one under v
                        if i < len(low):
                            side[v] = i if forward else len(low) - 1 - i
                size = int(np.frombuffer(r["size"], "<i2")[-1])
                out.append({"block": r["block"], "lcp0": int(lcp[0]), "last": size, "first_at": first.tolist(), "last_at": last.tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


# ---- the tree of a block


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each position the nearest one with a smaller value to the left (-1: none) and right (length: none), and whether no equal value lies between it and the left one."""
    left, right, lead, stack, v = [-1] * len(values), [len(values)] * len(values), [True] * len(values), [], values.tolist()
    for i, x in enumerate(v):
        while stack and v[stack[-1]] > x:
            right[stack.pop()] = i
        if stack:
            top = stack[-1]
            lead[i] = v[top] < x
            left[i] = top if lead[i] else left[top]
        stack.append(i)
    return np.array(left, np.int64), np.array(right, np.int64), np.array(lead, bool)


class Block:
    """All nodes whose first row lies in the block, in order of first row and depth, and the open levels at both edges."""

    def __init__(self, row: dict, width: int):
        self.width, self.start, self.block = width, row["start"], row["block"]
        self.next, self.prev = row["next"], row["prev"]
        self.lcp = np.frombuffer(row["lcp"], "<i2").astype(np.int64)
        self.lcp[0] = row["lcp0"]
        self.size = np.frombuffer(row["size"], "<i2").astype(np.int64)
        self.chunk, self.conv = np.frombuffer(row["chunk"], "<i8"), np.frombuffer(row["conv"], "<i8")
        self.n = n = len(self.lcp)
        self.left, self.right, lead = nearest_smaller(self.lcp)
        self.base = np.concatenate([[0], np.cumsum(self.size - self.lcp)])
        total = int(self.base[-1])
        self.row = np.repeat(np.arange(n), self.size - self.lcp)
        self.depth = np.arange(total) - self.base[self.row] + self.lcp[self.row] + 1
        self.end = np.full(total, -1, np.int64)  # the row after a node's last
        # Cartesian nodes that are closed in the block, equal values merged
        k = np.flatnonzero(lead & (self.left >= 0) & (self.right < n))
        self._expand(self.left[k], self.right[k], self.lcp[k])
        i = np.arange(n - 1)
        self._expand(i, i + 1, self.size[:-1])
        # levels open at the end
        self.open = []
        for d in range(int(self.size[-1]) + 1):
            if row["last_at"][d] >= 0:
                at = self.at(row["last_at"][d], d)
                self.end[at] = self.next[d] - self.start
                self.open.append(int(at))
        # levels open at the start, with the row after the last one here
        self.entering = [(d, row["first_at"][d] if row["first_at"][d] >= 0 else n) for d in range(min(int(self.lcp[0]), width - 1) + 1)]
        self.members = self.end - self.row
        wide = np.concatenate([[0], np.cumsum(self.size + 1)])
        weights = np.frombuffer(row["weights"], "<i8")
        self.weight = np.where(self.depth < width, (self.members - 1) * weights[wide[self.row] + self.depth], 0)
        self.upto = np.concatenate([[0], np.cumsum(self.weight)])
        self.saved = self.upto[self.base[1:]] - self.upto[self.base[:-1]]
        follows = np.append(self.lcp[1:], 0)
        self.leaf = ((self.size > follows) & (self.size < width)).astype(np.int64)
        last = int(self.size[-1])
        self.leaf[-1] = last < width and self.next[last] == self.start + n
        # a node's parent: the depth above from the same row, else the node that closes on its row's LCP
        same = self.depth - 1 > self.lcp[self.row]
        up = self.left[self.row]
        self.top = self.depth == 0
        self.parent = np.where(same, np.arange(total) - 1, np.where(up >= 0, self.at(np.maximum(up, 0), self.lcp[self.row]), -1))
        self.parent[self.top] = -1
        self.outside = (self.parent < 0) & ~self.top
        self.kids = np.bincount(self.parent[self.parent >= 0], minlength=total)

    def at(self, row, depth):
        return self.base[row] + depth - self.lcp[row] - 1

    def _expand(self, left: np.ndarray, right: np.ndarray, high: np.ndarray) -> None:
        """Depths of a node down from its own to the one under the nodes around it have the same rows."""
        low = np.maximum(self.lcp[left], self.lcp[right]) + 1
        many = np.maximum(high - low + 1, 0)
        first = np.repeat(self.at(left, low), many)
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        self.end[first + step] = np.repeat(right, many)

    def add(self, later: list[dict]) -> None:
        """What later pieces of the rows' conversations add to all nodes that hold them."""
        self.later_saved, self.later_leaves = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for x in later or []:
            self.later_saved[x["row"]], self.later_leaves[x["row"]] = x["saved"], x["leaves"]
        self.sums = [np.concatenate([[0], np.cumsum(v)]) for v in (self.saved, self.later_saved, self.leaf + self.later_leaves)]

    def below(self, at, end):
        """Saved bytes in the subtree of nodes, as far as rows before end go."""
        row = self.row[at]
        own = self.upto[self.base[row + 1]] - self.upto[at]
        saved, later, _ = self.sums
        return own + saved[end] - saved[row + 1] + later[end] - later[row]

    def ended(self, row: int, end: int, d: int) -> list[int]:
        return self.conv[row:end][self.size[row:end] == d].tolist()

    def parts(self) -> list[dict]:
        """For every node that goes over an edge of the block, what the rows of the block add to it."""
        out, lowest = [], np.minimum.accumulate(self.conv)
        from_end = np.minimum.accumulate(self.conv[::-1])[::-1]
        strangers = np.bincount(self.lcp[self.row[self.outside]], minlength=self.width + 1)
        saved, later, leaves = self.sums
        for d, end in self.entering:
            out.append({"block": self.block, "pos": self.prev[d], "d": d, "low": int(lowest[end - 1]), "saved": int(saved[end] + later[end]), "leaves": int(leaves[end]), "kids": int(strangers[d]), "ended": self.ended(0, end, d)})
        for at in self.open:
            row, d = int(self.row[at]), int(self.depth[at])
            if d < self.width:
                out.append({"block": self.block, "pos": self.start + row, "d": d, "low": int(from_end[row]), "saved": int(self.below(at, self.n)), "leaves": int(leaves[-1] - leaves[row]), "kids": int(self.kids[at]), "ended": self.ended(row, self.n, d)})
        return out

    def long_rows(self) -> list[dict]:
        """The rows of conversations that have several pieces."""
        out = []
        for i in np.flatnonzero((self.chunk > 0) | (self.size == self.width)).tolist():
            up = i
            while up >= 0 and self.lcp[up] >= self.width - 1:
                up = int(self.left[up]) if self.lcp[up] == self.width - 1 else up - 1
            last = None if self.size[i] < self.width else self.start + up if up >= 0 else self.prev[self.width - 1]
            out.append({"block": self.block, "row": i, "conv_id": int(self.conv[i]), "chunk": int(self.chunk[i]), "saved": int(self.saved[i]), "leaves": int(self.leaf[i]), "last_pos": last})
        return out

    def lows(self) -> np.ndarray:
        """The least conversation of each node that is closed in the block: minima of runs of 1, 2, 4, .. rows."""
        table = [self.conv]
        while 2 << (len(table) - 1) <= self.n:
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        end = np.minimum(self.end, self.n)
        out = np.empty(len(self.row), np.int64)
        step = np.frexp((end - self.row).astype(np.float64))[1] - 1
        for s in np.unique(step).tolist():
            at = np.flatnonzero(step == s)
            out[at] = np.minimum(table[s][self.row[at]], table[s][end[at] - (1 << s)])
        return out

    def nodes(self, wide: list[dict]) -> pa.RecordBatch:
        """The nodes; wide holds those that go over an edge."""
        known = {(x["pos"], x["d"]): x for x in wide or []}
        end, leaves = np.minimum(self.end, self.n), self.sums[2]
        low, kids, saved, leaf = self.lows(), self.kids.copy(), self.below(np.arange(len(self.row)), end), leaves[end] - leaves[self.row]
        digests: list[str] = [NOBODY] * len(self.row)
        whole = np.flatnonzero((self.depth == self.size[self.row]) & (self.depth < self.width))
        fresh = np.append(np.flatnonzero(self.lcp < self.size), self.n)
        after = fresh[np.searchsorted(fresh, self.row[whole], side="right")]
        for at, e in zip(whole.tolist(), after.tolist(), strict=True):
            digests[at] = hashlib.sha256(",".join(map(str, self.conv[self.row[at] : e].tolist())).encode()).hexdigest()
        for at in self.open:
            x = known.get((self.start + int(self.row[at]), int(self.depth[at])))
            if x:
                low[at], kids[at], saved[at], leaf[at], digests[at] = x["low"], x["kids"], x["saved"], x["leaves"], x["sha"] or NOBODY
        above = low[np.maximum(self.parent, 0)]
        for d, _ in self.entering:
            above[self.outside & (self.lcp[self.row] == d)] = known[self.prev[d], d]["low"]
        show = np.flatnonzero(self.depth < self.width)
        row = self.row[show]
        columns = [self.start + row, self.depth[show].astype(np.int32), self.chunk[row], self.conv[row], low[show], pa.array(above[show], mask=self.top[show]), self.members[show], kids[show], leaf[show], saved[show], pa.array([digests[i] for i in show.tolist()], pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=_schema(NODES))


def _each(width: int, kind: str):
    """A pass over the blocks that gives parts of wide nodes, rows of long conversations or all nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                (row,) = b.slice(i, 1).to_pylist()
                block = Block(row, width)
                if kind == "long":
                    yield pa.RecordBatch.from_pylist(block.long_rows(), schema=_schema(LONG))
                    continue
                block.add(row["later"])
                yield pa.RecordBatch.from_pylist(block.parts(), schema=_schema(PARTS)) if kind == "parts" else block.nodes(row["wide"])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node of sorted rows of ids; the ids of a node follow each other over any number of batches."""
    schema, now, state = _schema("pos bigint, d int, sha string"), None, None

    def done():
        return pa.RecordBatch.from_pylist([{"pos": now[0], "d": now[1], "sha": state.hexdigest()}], schema=schema)

    for b in batches:
        for pos, d, ids in zip(*(b.column(i) for i in range(3)), strict=True):
            key, more = (pos.as_py(), d.as_py()), ",".join(map(str, ids.as_py()))
            if key != now:
                if now is not None:
                    yield done()
                now, state = key, hashlib.sha256(more.encode())
            else:
                state.update(b"," + more.encode())
    if now is not None:
        yield done()


def trie(turns: DataFrame, *, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of turns (conv_id, place, digest, bytes, as rebuilt() gives them)."""
    spark = turns.sparkSession
    arrow_bounds(spark)
    blocks = sorted_blocks(pieces(turns, width), width, block)
    levels = settled(blocks.select("block", "lcp", "size", "head", "head_at", "before", "before_at").mapInArrow(lean(_levels(width)), LEVELS), "trie-levels")
    # the nearest smaller positions beyond a block, per level: windows over blocks
    places = blocks.select("block", "start", "n")
    steps = levels.select("block", F.posexplode(F.arrays_zip("first_at", "last_at")).alias("v", "x")).join(places, "block")
    steps = steps.select("block", "v", F.expr("if(x.first_at < 0, null, start + x.first_at)").alias("first"), F.expr("if(x.last_at < 0, null, start + x.last_at)").alias("last"))
    level = Window.partitionBy("v").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select("block", "v", F.last("first", ignorenulls=True).over(level.orderBy(F.col("block").desc())).alias("next"), F.last("last", ignorenulls=True).over(level.orderBy("block")).alias("prev"))
    rows = blocks.agg(F.sum("n")).first()[0] or 0
    around = steps.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("v", F.coalesce("next", F.lit(rows)).alias("next"), "prev"))).alias("s"))
    around = around.select("block", F.col("s.next").alias("next"), F.col("s.prev").alias("prev"))
    ready = settled(blocks.select("block", "start", "lcp", "size", "chunk", "conv", "weights", "long").join(levels, "block").join(around, "block"), "trie-ready")

    # what later pieces add to earlier ones, for conversations that have several
    long = settled(ready.where("long").mapInArrow(lean(_each(width, "long")), LONG), "trie-long")
    ahead = Window.partitionBy("conv_id").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = long.select("block", "row", F.sum("saved").over(ahead).alias("saved"), F.sum("leaves").over(ahead).alias("leaves")).where("saved is not null")
    later = later.groupBy("block").agg(F.collect_list(F.struct("row", "saved", "leaves")).alias("later"))
    ready = settled(ready.join(later, "block", "left"), "trie-later")

    # nodes that go over an edge: a row for each block and level
    parts = settled(ready.mapInArrow(lean(_each(width, "parts")), PARTS), "trie-parts")
    ended = parts.where("size(ended) > 0").select("pos", "d", "ended", "block").repartition("pos", "d").sortWithinPartitions("pos", "d", "block")
    digests = ended.select("pos", "d", "ended").mapInArrow(lean(_hashed), "pos bigint, d int, sha string")
    wide = parts.groupBy("pos", "d").agg(F.min("low").alias("low"), *(F.sum(c).alias(c) for c in ("saved", "leaves", "kids"))).join(digests, ["pos", "d"], "left")
    wide = parts.select("block", "pos", "d").join(wide, ["pos", "d"])
    wide = wide.groupBy("block").agg(F.collect_list(F.struct("pos", "d", "low", "saved", "leaves", "kids", "sha")).alias("wide"))
    nodes = settled(ready.join(wide, "block", "left").mapInArrow(lean(_each(width, "nodes")), NODES), "trie-nodes")

    # the parent of a later piece's first depth is the last depth of the piece before
    border = (F.col("d") == 0) & (F.col("chunk") > 0)
    over = long.where("last_pos is not null").select(F.col("conv_id").alias("member"), (F.col("chunk") + 1).alias("chunk"), F.col("last_pos").alias("pos"))
    parents = nodes.where(F.col("d") == width - 1).select("pos", F.col("conv_id").alias("above"))
    first = nodes.where(border).drop("parent_conv_id", "pos").join(over, ["member", "chunk"]).join(parents, "pos").withColumnRenamed("above", "parent_conv_id")
    depth = (F.col("chunk") * width + F.col("d")).alias("depth")
    return nodes.where(~border).unionByName(first).select("conv_id", depth, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return trie(rebuilt(table(spark, sf_dir, "conversations")))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS n,
         length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '') AS said, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         (4294967295 - list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint),
            lambda s, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(s, b)), 4294967295)) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS own, t.n, t.said, t.bytes FROM c JOIN t ON t.conv_id = c.base AND t.n < c.h
  UNION ALL SELECT c.conv_id, 1, t.n, t.said, t.bytes FROM c JOIN t ON t.conv_id = c.conv_id AND t.n >= c.h
), p AS (
  SELECT conv_id, row_number() OVER w AS depth, bytes, sha256(string_agg(sha256(said), ',') OVER w) AS node,
         count(*) OVER (PARTITION BY conv_id) AS len
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, n ROWS UNBOUNDED PRECEDING)
), m AS (
  SELECT conv_id, depth, bytes, node, len, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM p
), member AS (
  SELECT conv_id, depth, bytes, node, len, coalesce(up, 'root') AS up FROM m
  UNION ALL SELECT c.conv_id, 0, 0, 'root', (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id), NULL FROM c
), node AS (
  SELECT node, depth, min(conv_id) AS conv_id, any_value(up) AS up, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (len = depth), '')) AS ends_sha256
  FROM member GROUP BY node, depth
), kids AS (
  SELECT up AS node, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up
), below AS (
  SELECT DISTINCT a.node AS top, b.node FROM member a JOIN member b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), sums AS (
  SELECT top AS node, sum(node.saved) AS saved_tokens, count(*) FILTER (kids.n IS NULL) AS n_leaves
  FROM below JOIN node ON below.node = node.node LEFT JOIN kids ON below.node = kids.node GROUP BY top
)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0) AS n_children,
       sums.n_leaves::bigint AS n_leaves, sums.saved_tokens::bigint AS saved_tokens, node.ends_sha256
FROM node JOIN sums ON sums.node = node.node LEFT JOIN kids ON kids.node = node.node LEFT JOIN node parent ON parent.node = node.up
"""
