"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is `size` consecutive words of an item; an item of fewer words, but not none, is one window. A window is found
where all its words stand in a row, so containment is whole and the prefix that a match must share is one word. Words
are ordered by the number of documents that they are in, counted over all documents; the prefix is the window's rarest
word. A document is tried only where it has a prefix word, at the places that leave room for the window before and
after (the positional and length bounds), and there the words of the whole window are compared.

The index of items is held by each worker, so items go in blocks of at most BLOCK_WORDS words; documents pass over
the blocks one after another, whatever their number, and keep what they have found so far. The items never meet in one
task as a whole, and no document's words leave its row.

Very long texts are handled whole. Null texts have no words. Rows of items without id or words are no items. Documents are handled alone: repeated rows
are all kept; empty documents, items or tables give no hits or no rows. Further columns pass through only where asked.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import arrow_bounds, lean, settled, table, text_or_empty

SIZE = 13
#: Words of the items that a worker holds at once (about 100 bytes each).
BLOCK_WORDS = 500_000
#: Runs of anything but ASCII other than letters and digits; over UTF-8 after A-Z are lower-cased.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    """bytes.lower() changes A-Z alone."""
    return WORD.findall(text.lower())


def windows(item: list[bytes], size: int = SIZE) -> list[tuple[bytes, ...]]:
    return [tuple(item[i : i + size]) for i in range(max(1, len(item) - size + 1))] if item else []


class Index:
    """Windows by their words, and by their rarest word where it stands in the window and how long the window is."""

    def __init__(self, items: list[tuple[str, bytes]], seen: dict[bytes, int], size: int = SIZE):
        self.items: dict[tuple[bytes, ...], list[str]] = {}
        places: dict[bytes, set[tuple[int, int]]] = {}
        for item, text in items:
            for w in windows(words(text), size):
                rarest = min(w, key=lambda x: (seen.get(x, 0), x))
                if not seen.get(rarest, 0):
                    continue  # some word is in no document
                known = self.items.setdefault(w, [])
                if not known:
                    places.setdefault(rarest, set()).add((w.index(rarest), len(w)))
                if item not in known:
                    known.append(item)
        self.places = {w: sorted(x) for w, x in places.items()}
        self.prefixes = frozenset(self.places)

    def find(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Where windows stand (start, end), and the items that they are of."""
        hits, items = [], set()
        if found := self.prefixes.intersection(text):
            for i, w in enumerate(text):
                if w in found:
                    for offset, length in self.places[w]:
                        start = i - offset
                        if start >= 0 and start + length <= len(text) and (own := self.items.get(tuple(text[start : start + length]))):
                            hits.append((start, start + length))
                            items.update(own)
        return hits, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _frequency(docs: DataFrame, vocabulary: frozenset) -> dict[bytes, int]:
    """In how many documents each word of the vocabulary (of one block of items) is."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = shared.value, Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(own.intersection(words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    found = docs.mapInArrow(lean(run), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in found}


def contamination(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str], size: int = SIZE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns in keep, n_words, hits (merged spans of words, array of start and end) and items (sorted ids)."""
    spark = docs.sparkSession
    arrow_bounds(spark)
    names = [f"__k{i}" for i in range(len(keep))]
    own = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").cast("binary").alias("text"))
    at = docs.select(text_or_empty(text).cast("binary").alias("__text"), *(F.col(k).alias(n) for k, n in zip(keep, names, strict=True)))
    kinds = dict(at.dtypes)
    schema = ", ".join(["__text binary", *(f"{n} {kinds[n]}" for n in names), "n_words bigint, hits array<struct<s:bigint,e:bigint>>, items array<string>"])
    spans = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    state = at.withColumns({"n_words": F.lit(0).cast("bigint"), "hits": F.array().cast("array<struct<s:bigint,e:bigint>>"), "items": F.array().cast("array<string>")})
    texts = at.select("__text")
    sized = own.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(max(1, -(-(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (6 * block_words))))))
    count = (sized.agg(F.max("block")).first()[0] or 0) + 1
    for block in range(count):
        part = [(r["item"], bytes(r["text"])) for r in sized.where(F.col("block") == block).select("item", "text").collect()]
        seen = _frequency(texts, frozenset(w for _, t in part for w in words(t)))
        shared = spark.sparkContext.broadcast((part, seen))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value, size)
            for b in batches:
                sizes, hits, found = [], [], []
                for t, old, had in zip(b.column(0).to_pylist(), b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                    text = words(t)
                    h, i = index.find(text)
                    sizes.append(len(text))
                    hits.append([{"s": s, "e": e} for s, e in merged(h + [(x["s"], x["e"]) for x in old])] if h else old)
                    found.append(sorted(i.union(had)))
                yield pa.RecordBatch.from_arrays([*b.columns[:-3], pa.array(sizes, pa.int64()), pa.array(hits, spans), pa.array(found, pa.list_(pa.string()))], names=b.schema.names)

        state = state.mapInArrow(lean(run), schema)
        if block < count - 1:
            state = settled(state, "op9")
    return state.select(*(F.col(n).alias(k) for k, n in zip(keep, names, strict=True)), "n_words", "hits", "items")


def n_hit():
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["e"] - x["s"])


def contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that stand in windows of benchmark items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    counted = found.select("doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    return counted.withColumn("contaminated", contaminated())


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
    FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT k, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
    FROM (SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
m AS MATERIALIZED (SELECT k, i, size, item FROM dw JOIN bw USING (size, gram)),
hit AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT k, i, size FROM m)) GROUP BY k),
it AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM m) GROUP BY k)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (k) LEFT JOIN it USING (k)
"""
