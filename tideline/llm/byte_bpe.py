"""Byte-level BPE by backtracking over longest matches.

Bytes become Latin-1 characters, so that one Aho-Corasick automaton over all tokens gives, in one scan of a piece, the
tokens that start at each place. A sequence of tokens is what the merges make of its bytes exactly if each two tokens
beside each other are what the merges make of those two's bytes. So the encoder takes the longest token that fits the
one before it, and on reaching a place from which nothing fits it goes back and takes a shorter one; each place is
given up at most once. Whether two tokens fit is worked out once by merging their bytes, and remembered; tokens are of
bounded length, so a piece takes time in proportion to its length.

Null texts are empty: no ids, no bytes. Very long texts are handled whole, match by match. Each row is handled alone: ties, repeated rows and further columns play no part
and an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.chunks import Parts, together
from tideline.llm.common import ARROW_ROWS, arrow_bounds, held, lean, table, text_or_empty


class ByteBpe(Parts):
    def __init__(self, ranks: dict[bytes, int], pattern: str, **options):
        import ahocorasick
        import regex

        super().__init__(**{"size": 150_000, **options})
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.found = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.found.add_word(token.decode("latin-1"), (i, len(token)))
        self.found.make_automaton()
        self.beside: dict[tuple[int, int], bool] = {}
        (self.line,) = self.encode(["\n"])

    def merged(self, data: bytes) -> list[int]:
        """What the merges make of data, lowest rank first, leftmost of equals first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fit(self, a: int, b: int) -> bool:
        """Whether the merges leave token a and token b as they are side by side."""
        if (known := self.beside.get((a, b))) is None:
            if len(self.beside) > 200_000:
                self.beside.clear()
            known = self.beside[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def match(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        at: list[list[tuple[int, int]]] = [[] for _ in data]
        for end, (i, size) in self.found.iter(data.decode("latin-1")):
            at[end - size + 1].append((i, size))  # shorter ones come first
        out: list[int] = []
        places, left, dead = [0], [len(at[0]) - 1], set()
        while places[-1] < len(data):
            here = places[-1]
            while left[-1] >= 0:
                i, size = at[here][left[-1]]
                if here + size not in dead and (not out or self.fit(out[-1], i)):
                    break
                left[-1] -= 1
            else:
                dead.add(here)
                if not out:
                    return self.merged(data)  # no vocabulary made by merges comes to this
                out.pop(), places.pop(), left.pop()
                left[-1] -= 1
                continue
            out.append(i)
            places.append(here + size)
            left.append(len(at[here + size]) - 1 if here + size < len(data) else -1)
        return out

    def ids(self, text: str) -> list[int]:
        return [i for m in self.split(text) for i in self.match(m.encode("utf-8"))]

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(self.ids(t), "<u4").tobytes() for t in texts]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def load(path: str, pattern: str, **options) -> ByteBpe:
    """The vocabulary of a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return ByteBpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern, **options)


def encoded(df: DataFrame, *, vocabulary: str, pattern: str, text: str = "text", keep: list[str]) -> DataFrame:
    """The columns in keep, ids (array) and decoded (bytes, from the ids)."""
    arrow_bounds(df.sparkSession)
    source = df.select(*keep, text_or_empty(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(("bpe", vocabulary, pattern), lambda: load(vocabulary, pattern))
        for columns in together(batches, 1 << 20):
            ids, sizes = bpe(columns[-1])
            ends = np.cumsum(sizes)
            whole = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))
            decoded = [bpe.decode(ids[s:e].tolist()) for s, e in zip(ends - sizes, ends, strict=True)]
            out = pa.RecordBatch.from_arrays([*columns[:-1], whole, pa.array(decoded, pa.binary())], names=[*keep, "ids", "decoded"])
            for at in range(0, out.num_rows, ARROW_ROWS):
                yield out.slice(at, ARROW_ROWS)

    return source.mapInArrow(lean(run), ", ".join([*(f"`{n}` {t}" for n, t in source.dtypes[:-1]), "ids array<int>", "decoded binary"]))


def digests(df: DataFrame, *, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id with the number and digests of encoded()'s ids and bytes."""
    out = encoded(df.withColumn("doc_id", F.col("doc_id").cast("bigint")), vocabulary=vocabulary, pattern=pattern, keep=["doc_id"])
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(written.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), vocabulary=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN)
