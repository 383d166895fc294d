"""Language-model scores by a hierarchical Pitman-Yor model.

A token's restaurant is that of its context, the whole token before it (a text's first token stands after an end), known by
bits of its hash: SPARE more than the corpus has bytes, as a power of two, so that contexts hardly ever share them. All of these share the restaurant of all tokens, and its parent is uniform over the training types and
one unknown type. The tables of a restaurant are the customers of its parent. Seating is sampled by Gibbs: it starts with one
table per dish and restaurant; in each round the tables of every dish are drawn given its tables, the totals of its
restaurant and its probability in the parent as the round before left them (seating.py; all dishes at once, as on many
machines nothing else is possible). A text's score is the sum of log10 of its tokens' predictive probabilities, averaged over
the last rounds, each in steps of UNIT. Types never seen share the unknown type's probability.

Nothing is sampled, cut or capped: all tokens of all training texts are counted. A task turns its texts into chunks of
about CHUNK tokens. A chunk's distinct pairs of word and context go to the partition of the word, packed; which texts they
are in stays with the chunk. A partition counts its pairs. A pair seen once has one table whatever the rest does, so the
rounds hold only the others. What dishes of a context's restaurant in all partitions add up to is worked out in the
partition that owns the context: partitions send what they have and get the totals back. At the end each chunk gets the
probabilities of its pairs, and adds them up by text.

Words that a sample of the rows shows to be common are dealt by their contexts too, so no partition holds all places of
one. The sample decides only where words are counted, nothing else. The driver gets the totals of the restaurant of all
tokens, and those of these words, of which there are HOT times the partitions at most. What is held at once is a chunk, or a
partition's words, pairs and contexts; the number of partitions goes by the texts' bytes.

Tokens are maximal runs without ASCII white space after A-Z are lower-cased, then one end per text. Null texts are empty
ones: the end alone. A text longer than CHUNK is a chunk of its own. Every row gives a row, repeated rows too; equal texts
get equal scores. With no training tokens all types are unknown. Empty tables give none. Columns besides the two named are
not read.
"""

from __future__ import annotations

import gc
import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import arrow_bounds, crc_mod5, dropped, lean, settled, table, text_or_empty
from tideline.llm.seating import tables

CHUNK = 2_800_000
ROUNDS = 3
#: Rounds whose probabilities are averaged.
KEPT = 2
STRENGTH = 1.0
#: A word is common if it is more than one of HOT * partitions tokens; so many are dealt by their contexts at most.
HOT = 4
#: Rows looked at for common words, about.
LOOK = 4000
#: Scores are whole numbers of these.
UNIT = 1e-5
SPARE = 8
#: Bytes of texts to a partition.
PART_BYTES = 12 << 20


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _zip(data: bytes) -> bytes:
    """Compressed where that is worth it; the first byte says which."""
    return b"\1" + _ZIP.compress(data) if len(data) > 200 else b"\0" + data


def _unzip(data: bytes) -> bytes:
    return _UNZIP.decompress(data[1:]) if data[0] else data[1:]


def _packed(x: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones and so on, compressed."""
    return _zip(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes())


def _array(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(_unzip(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).reshape(-1)


def _rising(x: np.ndarray) -> bytes:
    """Rising numbers of 64 bits, packed as their differences."""
    return _packed(np.diff(x.astype("<u8"), prepend=np.uint64(0)))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(_array(data, "<u8"), dtype=np.uint64)


def _joined(words: list[bytes]) -> bytes:
    return _zip(b" ".join(words))


def _words(data: bytes) -> list[bytes]:
    """What _joined() got, which was at least one word; the end is the empty one."""
    return _unzip(data).split(b" ")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    names, types = zip(*(f.split(" ") for f in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def _batched(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most 512, or about 2 MB."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes)) + sum(len(y) for x in r if isinstance(x, list) for y in x if isinstance(y, bytes))
        if len(held) == 512 or size > 2 << 20:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def hashes(words: list[bytes], bits: int) -> np.ndarray:
    """The contexts that words make."""
    return np.frombuffer(b"".join([hashlib.blake2b(w, digest_size=8).digest() for w in words]), "<u8") >> np.uint64(64 - bits)


def partition_keys(spark: SparkSession, parts: int) -> np.ndarray:
    """A number for each of so many partitions that Spark deals to it by its hash, so that none gets several and others none."""
    found: dict[int, int] = {}
    size = 64 + 4 * parts
    while len(found) < parts:
        size *= 4
        rows = spark.range(size).select(F.col("id").cast("int").alias("k")).groupBy(F.pmod(F.hash("k"), F.lit(parts)).alias("p")).agg(F.min("k").alias("k"))
        found = {r.p: r.k for r in rows.collect()}
    return np.array([found[p] for p in range(parts)], np.int64)


def _count(texts: pa.Array) -> Counter:
    return Counter(w for t in texts.to_pylist() for w in [*t.lower().split(), b""])


def common_words(docs: DataFrame, n: int, parts: int) -> frozenset[bytes]:
    """Words that are more than one of HOT * parts tokens in a sample of n rows, and the end."""
    rows = docs.select(F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            seen += _count(b.column(0))
        yield _batch(list(seen.items()), "word binary, n bigint")

    counts = rows.sample(min(1.0, LOOK / max(1, n)), seed=1).mapInArrow(lean(run), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return frozenset([b"", *(bytes(r.word) for r in counts.where(F.col("n") * (HOT * parts) > total).collect())])


#: p < 0: a chunk's texts (ids; in pairs whether held out, in spread numbers of tokens). Else its words of a partition: each
#: word's number of contexts, those (places in contexts, which are hashes), how often in training; and in how many texts, and
#: texts and times.
CHUNKS = "p int, chunk bigint, words binary, pairs binary, pair_contexts binary, pair_counts binary, contexts binary, spread binary, texts binary, times binary, doc_ids array<bigint>"


def chunked(docs: DataFrame, keys: np.ndarray, common: frozenset[bytes], bits: int) -> DataFrame:
    """docs (doc_id, text, held_out) as CHUNKS."""
    parts = len(keys)

    def rows(number: int, docs: list[tuple], ids: list[np.ndarray], words: _Numbers) -> Iterator[tuple]:
        sizes = np.array([len(x) for x in ids], np.int64)
        held = np.array([d[1] for d in docs], bool)
        yield (-1, number, b"", _packed(held), b"", b"", b"", _packed(sizes.astype("<i8")), b"", b"", [d[0] for d in docs])
        names, n, v = list(words), len(docs), len(words)
        flat, text = np.concatenate(ids).astype(np.int64), np.repeat(np.arange(n), sizes)
        key = (flat * v + np.concatenate([flat[-1:], flat[:-1]])) * n + text  # each text's last token is the end
        del flat
        key, times = np.unique(key, return_counts=True)
        pair, text = key // n, (key % n).astype(np.uint32)
        del key
        begin = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        count, spread = np.add.reduceat(np.where(held[text], 0, times), begin), np.diff(begin, append=len(pair))
        word, context = pair[begin] // v, hashes(names, bits)[pair[begin] % v]
        del pair
        part = np.fromiter((zlib.crc32(w) for w in names), np.int64, v)[word]
        dealt = np.fromiter((w in common for w in names), bool, v)[word]
        part = (part + np.where(dealt, (context % np.uint64(parts)).astype(np.int64), 0)) % parts
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(ends)).tolist():
            at = order[ends[p] : ends[p + 1]]
            first = np.flatnonzero(np.diff(word[at], prepend=-1))
            contexts, place = np.unique(context[at], return_inverse=True)
            size = spread[at]
            where = np.repeat(begin[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
            learned = (_packed(np.diff(first, append=len(at)).astype("<u4")), _packed(place.astype("<u4")), _packed(count[at].astype("<u4")), _rising(contexts))
            yield (int(keys[p]), number, _joined([names[i] for i in word[at][first].tolist()]), *learned, _packed(size.astype("<u4")), _packed(text[where].astype("<u4")), _packed(times[where].astype("<u4")), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, docs, ids, words, held = TaskContext.get().partitionId() << 32, [], [], _Numbers(), 0
        for doc, text, out in _rows(batches):
            own = text.lower().split()
            own.append(b"")  # the end
            if docs and held + len(own) > CHUNK:  # a chunk is one text or CHUNK tokens at most
                yield from _batched(rows(number, docs, ids, words), CHUNKS)
                number, docs, ids, words, held = number + 1, [], [], _Numbers(), 0
            ids.append(np.fromiter(map(words.__getitem__, own), np.uint32, len(own)))
            docs.append((doc, out))
            held += len(own)
        if docs:
            yield from _batched(rows(number, docs, ids, words), CHUNKS)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), "held_out").mapInArrow(lean(run), CHUNKS)


class Pairs:
    """The pairs of a partition, from its chunks' rows (words, pairs, pair_contexts, pair_counts, contexts): word number << 32 |
    place in contexts in keys, rising, and their counts; at has the place in keys of each chunk's pairs."""

    def __init__(self, rows: list[tuple]):
        self.numbers, self.sizes, keys = _Numbers(), [], []
        self.contexts = np.unique(np.concatenate([_risen(r[4]) for r in rows]))
        for r in rows:
            own = np.fromiter(map(self.numbers.__getitem__, _words(r[0])), np.int64)
            keys.append(np.repeat(own << 32, _array(r[1], "<u4")))
            keys[-1] |= np.searchsorted(self.contexts, _risen(r[4]))[_array(r[2], "<u4")]
            self.sizes.append((own.astype(np.uint32), len(keys[-1])))
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.diff(keys, prepend=-1) > 0
        self.keys, self.at = keys[first], np.empty(len(keys), np.uint32)
        del keys
        self.at[order] = np.cumsum(first) - 1
        del order, first
        self.counts = np.bincount(self.at, np.concatenate([_array(r[3], "<u4") for r in rows]), len(self.keys)).astype(np.int64)
        self.words = list(self.numbers)

    @property
    def word(self) -> np.ndarray:
        return self.keys >> 32

    @property
    def context(self) -> np.ndarray:
        return self.keys & 0xFFFFFFFF


def _grouped(rows: Iterator[tuple]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows sorted by their first column, group by group without it."""
    key, held = None, []
    for r in rows:
        if held and r[0] != key:
            yield key, held
            held = []
        key = r[0]
        held.append(r[1:])
    if held:
        yield key, held


#: kind 0: a partition's words of the training texts, their tokens and pairs seen once; word number << 32 | place in contexts
#: of the pairs seen more often, rising, with their counts; those contexts; by round, these pairs' tables, and the words'
#: tables; then (from round 0 on) the contexts' pairs seen once in all partitions.
#: kind 1: all contexts that the partition meets, with its own customers and pairs seen once.
STATE = "kind int, p int, words binary, totals binary, singles binary, keys binary, counts binary, contexts binary, seated array<binary>, above array<binary>, customers binary, fixed binary"
_NAMES = tuple(f.split(" ")[0] for f in STATE.split(", "))


def counted(pairs: DataFrame, parts: int) -> DataFrame:
    """The rows of STATE of each partition, with one table per dish and restaurant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, held in _grouped(_rows(batches)):
            own = Pairs(held)
            once, often = own.counts == 1, own.counts > 1
            per = lambda at, size, weights=None: np.bincount(at, weights, size).astype("<i8")
            mine = _packed(per(own.context, len(own.contexts), own.counts)), _packed(per(own.context[once], len(own.contexts)))
            yield _batch([(1, p, *[b""] * 5, _rising(own.contexts), [], [], *mine)], STATE)
            totals, singles = per(own.word, len(own.words), own.counts), per(own.word[once], len(own.words))
            known = np.flatnonzero(totals)
            if not len(known):
                continue
            number = np.cumsum(totals > 0) - 1
            active, place = np.unique(own.context[often], return_inverse=True)
            keys = number[own.word[often]] << 32 | place
            seated = _packed(np.ones(len(keys), "<u4"))
            yield _batch([(0, p, _joined([own.words[i] for i in known.tolist()]), _packed(totals[known]), _packed(singles[known]), _rising(keys), _packed(own.counts[often]), _rising(own.contexts[active]), [seated], [_packed(np.ones(len(known), "<u4"))], b"", b"")], STATE)

    return pairs.select("p", "words", "pairs", "pair_contexts", "pair_counts", "contexts").repartition(parts, "p").sortWithinPartitions("p").mapInArrow(lean(run), STATE)


#: What partition p has of contexts (values by context), for the partition q that owns them; reply: whether p wants the sums.
ASKED = "q int, p int, reply boolean, contexts binary, values array<binary>"
ANSWERS = "p int, q int, sums array<binary>"


def _owned(contexts: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each partition that owns some of these contexts, and their places, in order."""
    parts = len(keys)
    owner = (contexts % np.uint64(parts)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    ends = np.searchsorted(owner[order], np.arange(parts + 1))
    for q in np.flatnonzero(np.diff(ends)).tolist():
        yield int(keys[q]), order[ends[q] : ends[q + 1]]


def _answered(asked: DataFrame, parts: int) -> DataFrame:
    """The sums of the values of each context, in the order in which they were asked for."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for q, held in _grouped(_rows(batches)):
            met = [_risen(h[2]) for h in held]
            found, at = np.unique(np.concatenate(met), return_inverse=True)
            sums = []
            for k in range(max(len(h[3]) for h in held)):
                sums.append(np.bincount(at, np.concatenate([_array(h[3][k], "<i8") if h[3][k] else np.zeros(len(m), "<i8") for h, m in zip(held, met, strict=True)]), len(found)).astype("<i8")[at])
            ends = np.cumsum([0, *map(len, met)]).tolist()
            for h, s, e in zip(held, ends, ends[1:], strict=False):
                if h[1]:
                    yield h[0], q, [_packed(x[s:e]) for x in sums]

    return asked.repartition(parts, "q").sortWithinPartitions("q").mapInArrow(lean(lambda batches: _batched(add(batches), ANSWERS)), ANSWERS)


def _asks(state: DataFrame, keys: np.ndarray, of) -> DataFrame:
    """of(row of STATE) gives reply and values by context (None: zeros), or None where it has nothing to ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for values in _rows(batches):
            row = dict(zip(_NAMES, values, strict=True))
            if (asked := of(row)) is not None:
                contexts = _risen(row["contexts"])
                for q, at in _owned(contexts, keys):
                    yield q, row["p"], asked[0], _rising(contexts[at]), [None if x is None else _packed(x[at]) for x in asked[1]]

    return state.select(*_NAMES).mapInArrow(lean(lambda batches: _batched(run(batches), ASKED)), ASKED)


def _tables(row: dict, k: int) -> np.ndarray:
    """The tables of pairs seen more than once, by context."""
    context = (_risen(row["keys"]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return np.bincount(context, _array(row["seated"][k], "<u4"), len(_risen(row["contexts"]))).astype("<i8")


def _fixed(row: dict) -> tuple[bool, list]:
    """Pairs seen once of all contexts; the contexts with other pairs get the sums."""
    return row["kind"] == 0, [_array(row["fixed"], "<i8") if row["kind"] else None]


def _last(row: dict) -> tuple[bool, list] | None:
    """The tables of the last round's pairs."""
    return (True, [_tables(row, -1)]) if row["kind"] == 0 else None


def _all(kept: int):
    """Customers and pairs seen once of all contexts, and the tables of the other pairs in the last rounds; all contexts get the sums."""

    def of(row: dict) -> tuple[bool, list]:
        if row["kind"] == 1:
            return True, [_array(row["customers"], "<i8"), _array(row["fixed"], "<i8"), *[None] * kept]
        return False, [None, None, *(_tables(row, k - kept) for k in range(kept))]

    return of


class Round:
    """What a round shares: customers and tables of the restaurant of all tokens, the discounts by order, training tokens and types.

    hot has, for each common word, its tokens, its customers and its tables in the restaurant of all tokens.
    """

    def __init__(self, customers: int, tables: int, d: list[float], n: int, types: int, hot: dict[bytes, tuple[int, int, int]]):
        self.customers, self.tables, self.d, self.n, self.types, self.hot = customers, tables, d, n, types, hot
        self.root, self.latest = 1 / (types + 1), self
        self.rest = (STRENGTH + d[1] * tables) / (STRENGTH + customers)

    def weight(self, own: np.ndarray) -> tuple[np.ndarray, float]:
        """What opening a table in the restaurant of all tokens weighs for dishes that have so many there, and by how much it grows."""
        return (STRENGTH + self.d[1] * (self.tables - own)) * self.root, self.d[1] * self.root

    def chance(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The probability of words in the restaurant of all tokens."""
        return np.maximum(customers - self.d[1] * tables, 0) / (STRENGTH + self.customers) + self.rest * self.root


class Part:
    """A partition's words and their pairs seen more than once."""

    def __init__(self, row: dict):
        self.row, self.words = row, _words(row["words"])
        self.totals, self.singles, self.counts, self.contexts = _array(row["totals"], "<i8"), _array(row["singles"], "<i8"), _array(row["counts"], "<i8"), _risen(row["contexts"])
        keys = _risen(row["keys"]).astype(np.int64)
        self.word, self.context = keys >> 32, keys & 0xFFFFFFFF

    def above(self, k: int) -> np.ndarray:
        """The words' customers in the restaurant of all tokens, of this partition's pairs."""
        return self.singles + np.bincount(self.word, _array(self.row["seated"][k], "<u4"), len(self.words)).astype(np.int64)

    def chance(self, r: Round, k: int) -> np.ndarray:
        """The words' probabilities in the restaurant of all tokens."""
        customers, own = self.above(k), _array(self.row["above"][k], "<u4").astype(np.int64)
        for i, w in enumerate(self.words):
            if w in r.hot:
                _, customers[i], own[i] = r.hot[w]
        return r.chance(customers, own)


def seated(state: DataFrame, answers: DataFrame, last: Round, number: int, keys: np.ndarray, kept: int) -> DataFrame:
    """A round: every partition's dishes get this round's tables, given the totals of the round before. The last `kept` are kept.

    Round 0 only takes the contexts' fixed totals over.
    """
    names = (*_NAMES, "q", "sums")

    def new(part: Part, sums: list[np.ndarray]) -> pa.RecordBatch:
        row = part.row
        if not number:
            return _batch([tuple(row[n] for n in _NAMES[:-1]) + (_packed(sums[0]),)], STATE)
        draw, word = np.random.default_rng([number, row["p"]]), part.chance(last, -1)
        before = _array(row["seated"][-1], "<u4").astype(np.int64)
        others = (_array(row["fixed"], "<i8") + sums[0])[part.context] - before
        own = tables(part.counts, (STRENGTH + last.d[0] * others) * word[part.word], last.d[0], draw, last.d[0] * word[part.word])
        row = row | {"seated": [*row["seated"], _packed(own.astype("<u4"))]}
        weight, step = last.weight(_array(row["above"][-1], "<u4").astype(np.int64))
        top = tables(Part(row).above(-1), weight, last.d[1], draw, step)
        row |= {"above": [*row["above"], _packed(top.astype("<u4"))]}
        return _batch([tuple(row[n][-kept:] if n in ("seated", "above") else row[n] for n in _NAMES)], STATE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums, places = None, [], {}
        for values in _rows(batches):
            row = dict(zip(names, values, strict=True))
            if row["q"] < 0:  # a partition's state comes before its answers
                if part:
                    yield new(part, sums)
                part = Part(row)
                sums, places = [np.zeros(len(part.contexts), "<i8")], dict(_owned(part.contexts, keys))
            else:
                for x, data in zip(sums, row["sums"], strict=True):
                    x[places[row["q"]]] = _array(data, "<i8")
        if part:
            yield new(part, sums)

    wide = _wide(state, {"q": "int", "sums": "array<binary>"}, names)
    return wide(state.where("kind = 0").withColumn("q", F.lit(-1))).unionAll(wide(answers)).repartition(len(keys), "p").sortWithinPartitions("p", "q").mapInArrow(lean(run), STATE)


def _wide(like: DataFrame, more: dict[str, str], names: tuple[str, ...]):
    kinds = dict(like.dtypes) | more
    return lambda df: df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names))


SUMS = "word binary, n bigint, types bigint, customers bigint, tables bigint, once bigint, twice bigint, once_above bigint, twice_above bigint"


def round_totals(state: DataFrame, first: Round | None, common: frozenset[bytes], number: int) -> Round:
    """The round's totals, added up before they come to the driver: one row for all, and one for each common word.

    Discounts come from the first seating's customers: n1 / (n1 + 2 n2).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _rows(batches):
            part = Part(dict(zip(_NAMES, values, strict=True)))
            above, top, counts = part.above(-1), _array(part.row["above"][-1], "<u4").astype(np.int64), part.counts
            hot = np.fromiter((w in common for w in part.words), bool, len(part.words))
            pairs = int(part.singles.sum()), int((counts == 2).sum())
            rows = [(None, *(int(x) for x in (part.totals.sum(), (~hot).sum(), above.sum(), top[~hot].sum(), *pairs, (above[~hot] == 1).sum(), (above[~hot] == 2).sum())))]
            rows += [(part.words[i], int(part.totals[i]), 1, int(above[i]), 0, 0, 0, 0, 0) for i in np.flatnonzero(hot).tolist()]
            yield _batch(rows, SUMS)

    names = [f.split(" ")[0] for f in SUMS.split(", ")][1:]
    found = state.where("kind = 0").select(*_NAMES).mapInArrow(lean(run), SUMS).groupBy("word").agg(*(F.sum(c).alias(c) for c in names)).collect()
    one = {c: sum(r[c] for r in found if r.word is None) for c in names}
    words = sorted((bytes(r.word), r.n, r.customers) for r in found if r.word is not None)
    types = one["types"] + len(words)
    once, twice = (one[f"{k}_above"] + sum(c == i for _, _, c in words) for k, i in (("once", 1), ("twice", 2)))
    d = first.d if first else [float(np.clip(a / max(1, a + 2 * b), 0.05, 0.95)) for a, b in ((one["once"], one["twice"]), (once, twice))]
    # the common words' tables in the restaurant of all tokens are drawn here, as their customers are in many partitions
    top = np.ones(len(words), np.int64)
    if first and words:
        last = first.latest
        weight, step = last.weight(np.array([last.hot[w][2] for w, _, _ in words]))
        top = tables(np.array([c for _, _, c in words]), weight, d[1], np.random.default_rng([number, 1 << 40]), step)
    hot = {w: (n, c, int(t)) for (w, n, c), t in zip(words, top, strict=True)}
    out = Round(one["customers"], one["tables"] + int(top.sum()), d, one["n"], types, hot)
    (first or out).latest = out
    return out


class Model:
    """The averaged rounds, the number of training tokens n and of types v."""

    def __init__(self, n: int, v: int, rounds: list[Round]):
        self.n, self.v, self.rounds = n, v, rounds

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.n + 0.5 * (self.v + 1)))


#: For the words of a chunk in a partition, in their order: how often they are in training, and their pairs' scores in UNITs.
GIVEN = "chunk bigint, p int, totals binary, scores binary"


def _given(model, names: tuple[str, ...], keys: np.ndarray) -> object:
    """Rows of a partition by step: its state (0), its chunks' words (1), the totals of all its contexts (2)."""

    def done(m: Model, row: dict | None, held: list[dict], answers: list[tuple]) -> Iterator[tuple]:
        own = Pairs([tuple(r[n] for n in ("words", "pairs", "pair_contexts", "pair_counts", "contexts")) for r in held])
        heads = [(r["chunk"], r["p"]) for r in held]
        held.clear()
        sums, places = np.zeros((2 + len(m.rounds), len(own.contexts)), np.int64), dict(_owned(own.contexts, keys))
        for q, data in answers:
            for x, d in zip(sums, data, strict=True):
                x[places[q]] = _array(d, "<i8")
        answers.clear()
        customers, fixed, *free = sums
        totals, part, chances = np.zeros(len(own.words), np.int64), Part(row) if row else None, np.zeros(len(own.keys))
        if part:
            number = np.array([own.numbers[w] for w in part.words])
            totals[number] = part.totals
            at = np.searchsorted(own.keys, number[part.word] << 32 | np.searchsorted(own.contexts, part.contexts)[part.context])
        room = 1 / (STRENGTH + customers)
        for k, r in enumerate(m.rounds):
            chance, tables = np.full(len(own.words), r.rest * r.root), np.ones(len(own.keys), np.uint32)
            if part:
                tables[at] = _array(row["seated"][k], "<u4")
                chance[number] = part.chance(r, k)
            for w, (n, c, t) in r.hot.items():
                if (i := own.numbers.get(w)) is not None:
                    totals[i], chance[i] = n, r.chance(np.array([c]), np.array([t]))[0]
            rest = (STRENGTH + r.d[0] * (fixed + free[k])) * room
            chances += np.maximum(own.counts - r.d[0] * tables, 0) * room[own.context] + rest[own.context] * chance[own.word]
        score = np.rint(np.log10(chances / len(m.rounds)) / -UNIT).astype("<u4")
        begin = 0
        for (chunk, p), (words, size) in zip(heads, own.sizes, strict=True):
            yield chunk, p, _packed(totals[words].astype("<i8")), _packed(score[own.at[begin : begin + size]])
            begin += size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        m: Model = model.value
        p, row, held, answers = None, None, [], []
        for values in _rows(batches):
            r = dict(zip(names, values, strict=True))
            if r["p"] != p:
                if held:
                    yield from done(m, row, held, answers)
                p, row, held, answers = r["p"], None, [], []
            if r["step"] == 0:
                row = r
            elif r["step"] == 1:
                held.append(r)
            else:
                answers.append((r["q"], r["sums"]))
        if held:
            yield from done(m, row, held, answers)

    return lambda batches: _batched(run(batches), GIVEN)


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _texts(model):
    """Rows chunk, p (-1 first), step, a to d, doc_ids sorted by chunk, p and step: adds up what each chunk's texts are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        docs = None

        def done():
            return _batch(list(zip(docs, held.tolist(), sizes.tolist(), known.astype(np.int64).tolist(), base.tolist(), (score * -UNIT).tolist(), strict=True)), RESULT)

        for _, p, step, a, b, c, d, ids in _rows(batches):
            if p < 0:
                if docs:
                    yield done()
                docs, held, sizes = ids, _array(a, "?"), _array(b, "<i8")
                known, base, score = np.zeros((3, len(docs)))
            elif step == 0:
                spread, text, times = _array(b, "<u4"), _array(c, "<u4"), _array(d, "<u4").astype(np.float64)
                pairs = _array(a, "<u4")
            else:
                totals = np.repeat(_array(a, "<i8"), pairs)
                each = lambda x: np.bincount(text, np.repeat(x, spread) * times, len(docs))  # noqa: B023, E731
                known += each(totals > 0)
                base += each(m.base(totals))
                score += each(_array(b, "<u4"))
        if docs:
            yield done()

    return run


def _freed(spark: SparkSession) -> None:
    """Free the disk of shuffles that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scored(docs: DataFrame, held_out: Column, *, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, kept: int = KEPT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text; learns from those not held out."""
    spark, kept = docs.sparkSession, min(kept, rounds + 1)
    arrow_bounds(spark)
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"), held_out.alias("held_out"))
    size = own.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).alias("bytes")).first()
    parts = max(4, -(-size.bytes // PART_BYTES))
    keys = partition_keys(spark, parts)
    common = common_words(own, size.n, parts)
    chunks = settled(chunked(own, keys, common, min(64, max(32, size.bytes.bit_length() + SPARE))), "op1-chunks")
    words = chunks.where("p >= 0").select("p", "chunk", "words", "pairs", "pair_contexts", "pair_counts", "contexts")
    pairs = settled(counted(words, parts), "op1-pairs")
    first = round_totals(pairs, None, common, 0)
    history, state = [first], pairs
    for number in range(rounds + 1):
        old = state
        state = settled(seated(old, _answered(_asks(old, keys, _last if number else _fixed), parts), history[-1], number, keys, kept), "op1-seated")
        if number:
            history.append(round_totals(state, first, common, number))
            dropped(old)
        _freed(spark)
    model = spark.sparkContext.broadcast(Model(first.n, first.types, history[-kept:]))
    answers = settled(_answered(_asks(pairs.where("kind = 1").unionAll(state), keys, _all(kept)), parts), "op1-answers")
    dropped(pairs)
    _freed(spark)
    names = ("p", "step", "q", "chunk", "words", "totals", "singles", "keys", "counts", "contexts", "seated", "above", "sums", "pairs", "pair_contexts", "pair_counts")
    wide = _wide(chunks, dict(state.dtypes) | {"step": "int", "q": "int", "sums": "array<binary>"}, names)
    step = lambda df, n: wide(df.withColumn("step", F.lit(n)))
    dealt = step(state, 0).unionAll(step(words, 1)).unionAll(step(answers, 2))
    given = settled(dealt.repartition(parts, "p").sortWithinPartitions("p", "step", "chunk").mapInArrow(lean(_given(model, names, keys)), GIVEN), "op1-given")
    dropped(state, answers)
    _freed(spark)
    none, no_ids = F.lit(None).cast("binary"), F.lit(None).cast("array<bigint>").alias("doc_ids")
    heads = chunks.where("p < 0").select("chunk", "p", F.lit(0).alias("step"), F.col("pairs").alias("a"), F.col("spread").alias("b"), none.alias("c"), none.alias("d"), "doc_ids")
    places = chunks.where("p >= 0").select("chunk", "p", F.lit(0), "pairs", "spread", "texts", "times", no_ids)
    merged = heads.unionAll(places).unionAll(given.select("chunk", "p", F.lit(1), "totals", "scores", none, none, no_ids)).repartition(parts, "chunk").sortWithinPartitions("chunk", "p", "step")
    out = merged.mapInArrow(lean(_texts(model)), RESULT)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(first.n).cast("bigint").alias("train_tokens"), "base_score", "score")


def perplexity(scores: DataFrame) -> DataFrame:
    """Perplexity per token over rows of scored(), by held_out."""
    tokens = F.sum("n_tokens")
    return scores.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum("score") / tokens).alias("perplexity"), F.pow(F.lit(10.0), -F.sum("base_score") / tokens).alias("base_perplexity"), tokens.alias("n_tokens"))


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability."""
    return scored(table(spark, sf_dir, "documents"), crc_mod5() == 1)
