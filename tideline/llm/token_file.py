"""Token ids in files of patched frame-of-reference blocks.

File format: a Parquet table of segments. A segment holds whole documents in ascending order and the ids of all of
them: columns part and segment (its place), offset (ids of its part before it), n_tokens, doc_ids and lengths (one per
document) and payload. A payload, all little-endian, is

    u32 number of ids, u32 number of blocks, u32[blocks] where each block starts within the payload,
    and per block of 256 ids: u32 minimum, u8 width, u8 exceptions - 1 if there are any (else 0), u8 flag, u8 zero,
    256 * width bits of (id - minimum) cut to width bits, then for each exception u8 place and u32 (id - minimum).

The width is the number of bits that the chosen percentile of a block's differences needs; what doesn't fit is an
exception. Segments end at documents, at the first end at or after SEGMENT ids, so a block start leads to any id.

A very long text is a segment of its own, encoded whole. A null text is an empty one (its document is the end id alone). Documents with equal ids are ordered by text and all
kept; a null id comes first. An empty table gives no files' rows. Further columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.chunks import Parts, together
from tideline.llm.common import arrow_bounds, held, lean, shared_dir, table, text_or_empty

BLOCK = 256
SEGMENT = 1 << 16
PERCENTILE = 97
SEGMENTS = "part int, segment int, offset bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary"


def _cut(x: np.ndarray, width: int) -> np.ndarray:
    """The low bits of each number in rows of x, packed; a row of packed bytes for each."""
    raw = x.astype("<u2" if width <= 16 else "<u4")
    bits = np.unpackbits(raw.view(np.uint8), axis=1, bitorder="little").reshape(len(x), x.shape[1], -1)
    return np.packbits(bits[:, :, :width].reshape(len(x), -1), axis=1, bitorder="little")


def _whole(rows: np.ndarray, width: int) -> np.ndarray:
    """The numbers of packed rows."""
    kind = "<u2" if width <= 16 else "<u4"
    bits = np.zeros((len(rows), BLOCK, 16 if width <= 16 else 32), np.uint8)
    bits[:, :, :width] = np.unpackbits(rows, axis=1, bitorder="little").reshape(len(rows), BLOCK, width)
    return np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little").view(kind)


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return np.array([0, 0], "<u4").tobytes()
    x = np.concatenate([ids, np.full(blocks * BLOCK - n, ids[-1], ids.dtype)]).astype(np.uint32).reshape(blocks, BLOCK)
    low = x.min(axis=1)
    x -= low[:, None]
    nth = min(BLOCK - 1, int(BLOCK * percentile / 100))
    width = np.ceil(np.log2(np.partition(x, nth, axis=1)[:, nth].astype(np.float64) + 1)).astype(np.uint32)
    out: list[bytes] = [b""] * blocks
    over = x > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        for i, row in zip(at.tolist(), _cut(x[at], w), strict=True):
            places = np.flatnonzero(over[i])
            head = int(low[i]).to_bytes(4, "little") + bytes([w, max(0, len(places) - 1), len(places) > 0, 0])
            out[i] = head + row.tobytes() + places.astype(np.uint8).tobytes() + x[i, places].astype("<u4").tobytes()
    starts = 8 + 4 * blocks + np.cumsum([0, *map(len, out[:-1])])
    return np.array([n, blocks, *starts], "<u4").tobytes() + b"".join(out)


def _block(data: bytes, at: int) -> tuple[int, int, np.ndarray, np.ndarray, int]:
    width, fewer, flag = data[at + 4], data[at + 5], data[at + 6]
    count, body = fewer + flag, at + 8 + BLOCK // 8 * width
    return int.from_bytes(data[at : at + 4], "little"), width, np.frombuffer(data, np.uint8, count, body), np.frombuffer(data, "<u4", count, body + count), at + 8


def unpack(data: bytes) -> np.ndarray:
    """All ids of a payload."""
    n, blocks = np.frombuffer(data, "<u4", 2)
    starts = np.frombuffer(data, "<u4", blocks, 8)
    parts = [_block(data, int(s)) for s in starts]
    out, raw = np.empty((blocks, BLOCK), np.uint32), np.frombuffer(data, np.uint8)
    widths = np.array([p[1] for p in parts], np.int64)
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        rows = np.stack([raw[parts[i][4] : parts[i][4] + BLOCK // 8 * w] for i in at]) if w else np.empty((len(at), 0), np.uint8)
        out[at] = _whole(rows, int(w))
    for i, (low, _, places, values, _) in enumerate(parts):
        out[i, places] = values
        out[i] += np.uint32(low)
    return out.reshape(-1)[:n]


def unpack_from(data: bytes, start: int, count: int) -> np.ndarray:
    """ids start to start + count of a payload, reading the blocks that hold them only."""
    n, blocks = np.frombuffer(data, "<u4", 2)
    first, last = start // BLOCK, min(int(blocks), -(-(start + count) // BLOCK))
    starts = np.frombuffer(data, "<u4", int(blocks), 8)[first:last].astype(np.int64)
    if not len(starts):
        return np.empty(0, np.uint32)
    end = int(starts[-1])
    _, _, places, values, body = _block(data, end)
    end = body + BLOCK // 8 * data[end + 4] + 5 * len(places)
    head = 8 + 4 * len(starts)
    part = np.array([len(starts) * BLOCK, len(starts), *(starts - starts[0] + head)], "<u4").tobytes() + data[starts[0] : end]
    return unpack(part)[start - first * BLOCK : min(start + count, int(n)) - first * BLOCK]


class Library(Parts):
    """Ids from the tokenizers library. New parts go to it together, with a line end (always an id of its own there) between them."""

    def __init__(self, tokenizer: str, **options):
        super().__init__(**options)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(tokenizer)
        (self.line,) = self.encode(["\n"])

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.own.encode_batch(texts, add_special_tokens=False)]

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(parts), 512):
            some = parts[at : at + 512]
            ids = np.array(self.own.encode("\n".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(ids == np.frombuffer(self.line, "<u4")[0])
            if len(self.line) == 4 and len(ends) == len(some) - 1:
                raw, cuts = ids.tobytes(), [-4, *(4 * ends).tolist(), 4 * len(ids)]
                out += [raw[s + 4 : e] for s, e in zip(cuts, cuts[1:], strict=False)]
            else:  # not such a vocabulary
                out += self.encode(some)
        return out


def _writer(tokenizer: str, end_id: int, segment: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), held(("library", tokenizer), lambda: Library(tokenizer))
        docs, lengths, ids, filled, number, offset = [], [], [], 0, 0, 0

        def segment_row():
            payload = pack(np.concatenate(ids))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            row = [part, number, offset, filled, docs, lengths, payload]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in SEGMENTS.split(", ")])

        for (names, texts) in together(batches):
            names = names.to_pylist()
            own, size = encode(texts, end)
            upto, at = np.cumsum(size), 0
            while at < len(size):
                begin = upto[at] - size[at]
                # up to the first document that fills the segment
                to = min(int(np.searchsorted(upto, begin + segment - filled)) + 1, len(size))
                docs += names[at:to]
                lengths += size[at:to].tolist()
                ids.append(own[begin : upto[to - 1]])
                filled, at = filled + int(upto[to - 1] - begin), to
                if filled >= segment:
                    yield segment_row()
                    number, offset = number + 1, offset + filled
                    docs, lengths, ids, filled = [], [], [], 0
        if docs:
            yield segment_row()

    return run


def write_tokens(df: DataFrame, path: str, *, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", segment: int = SEGMENT) -> None:
    """Encode the texts in ascending order of doc_id, each with end_id after it, into a file table at path.

    Range partitions keep the order between tasks, a sort keeps it within one; each task keeps one segment in memory.
    """
    spark = df.sparkSession
    arrow_bounds(spark)
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lean(_writer(tokenizer, end_id, segment)), SEGMENTS).write.option("compression", "zstd").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The file table with base: the ids of all parts before a segment's own. Parts are as many as the writer's tasks."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    totals, base, before = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect(), [], 0
    for row in totals:
        base.append((row["part"], before))
        before += row["n"]
    bases = spark.createDataFrame(base, "part int, base bigint")
    return files.join(F.broadcast(bases), "part")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for docs, lengths, payload, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
            ids, ends = unpack(payload), np.cumsum(lengths)
            starts = ends - lengths
            raw = [ids[s:e].astype("<u4").tobytes() for s, e in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts + first), pa.array(lengths, pa.int64()), pa.array(raw, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (u32, little-endian) of every document, from the files."""
    arrow_bounds(spark)
    segments = read_segments(spark, path).select("doc_ids", "lengths", "payload", (F.col("base") + F.col("offset")).alias("first"))
    return segments.mapInArrow(lean(_documents), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, written to the file format and read back from it."""
    import public_tokenizers

    path = shared_dir(spark, "op4")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
