"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features: densities of a lexicon (a short list of insults, and words and word beginnings that mark the label in the
training rows), insults near a second-person word, capitals, punctuation and obfuscation rates. What is learned comes
from a bounded sample of the labelled rows: the SAMPLE rows with the smallest hash of their id, in thirds. The features of
a third go by a lexicon learned from the other two, so that they are as good as those of unseen texts; two thirds make
the trees, the last their calibration. Everything else runs over whole texts of all rows.

The label is the only thing learned from, and no id, language or source enters a score. Null and empty texts are scored
from their features like others, very long ones whole. Copies get equal scores. Without labelled rows of both classes every score is the
share of the one label (0 if there is none). Empty tables give no rows; a doc_id labelled twice counts once (its highest
label), and columns besides those named are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import arrow_bounds, crc_mod5, lean, settled, table, text_or_empty

#: Labelled rows that are learned from, at most.
SAMPLE = 15_000
INSULTS = frozenset("idiot idiots moron morons scum loser losers clown clowns trash garbage stupid dumb pathetic worthless disgusting filth vermin bastard bitch imbecile idiota imbécil estúpido estúpida basura asqueroso imbécile crétin connard ordure débile dummkopf arschloch abschaum trottel vollidiot blöd ekelhaft".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
_LEET = str.maketrans("013457@$!|", "oieastasil")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
#: Codes of a token.
PLAIN, INSULT, STRONG, WEAK, SECOND, HIDDEN = range(6)
_NEAR = re.compile(rb"[\x01\x02\x05](?=[^\x04]{0,5}\x04)|\x04(?=[^\x01\x02\x05]{0,5}[\x01\x02\x05])", re.DOTALL)
FEATURES = ("words", "insults", "strong", "weak", "hidden", "second", "near", "marked", "capitals", "exclamations", "punctuation", "digits", "doubled")


def keys(word: str) -> set[str]:
    """A word and its beginnings of 4 to 8 letters, as the lexicon knows them."""
    return {"=" + word, *("^" + word[:k] for k in range(4, min(8, len(word)) + 1))}


def bare(token: str) -> str:
    return _EDGE.sub("", token)


class Codes(dict):
    """The code of each lower-cased token; as many as fit are remembered."""

    def __init__(self, strong: frozenset[str], weak: frozenset[str]):
        super().__init__()
        self.strong, self.weak = strong, weak

    def __missing__(self, token: str) -> int:
        word = bare(token)
        own = keys(word)
        if word in INSULTS:
            code = INSULT
        elif word in SECOND_PERSON:
            code = SECOND
        elif not own.isdisjoint(self.strong):
            code = STRONG
        elif not own.isdisjoint(self.weak):
            code = WEAK
        else:
            plain = _INNER.sub("", word.translate(_LEET))
            code = HIDDEN if plain != word and plain in INSULTS else PLAIN
        if len(token) <= 64:  # longer ones are worked out anew
            if len(self) > 200_000:
                self.clear()
            self[token] = code
        return code


def features(text: str, codes: Codes) -> list[float]:
    tokens = text.lower().split()
    code = bytes(map(codes.__getitem__, tokens))
    n = max(1, len(code))
    count = [code.count(c) for c in range(6)]
    near = len(_NEAR.findall(code)) if count[SECOND] else 0
    raw = np.frombuffer(text.encode(), np.uint8)
    by = np.bincount(raw, minlength=256) if len(raw) else np.zeros(256, np.int64)
    size, upper = max(1, len(raw)), int(by[65:91].sum())
    letters = upper + int(by[97:123].sum())
    marks = int(by[33:48].sum() + by[58:65].sum() + by[91:97].sum() + by[123:127].sum())
    doubled = text.count("!!") + text.count("??")
    marked = count[INSULT] + count[STRONG] + count[HIDDEN]
    return [np.log1p(len(code)), count[INSULT] / n, count[STRONG] / n, count[WEAK] / n, count[HIDDEN] / n, count[SECOND] / n, near / n, np.log1p(marked), upper / max(1, letters), by[33] / size, marks / size, int(by[48:58].sum()) / size, doubled / n]


class Trees:
    """Boosted regression trees for the logistic loss, over features cut at quantiles."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, least: float = 1.0, cuts: int = 64):
        self.rounds, self.depth, self.rate, self.least, self.cuts = rounds, depth, rate, least, cuts
        self.base, self.trees, self.edges = 0.0, [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.cuts + 1)[1:-1])) if len(c) else np.empty(0) for c in x.T]
        if not 0 < y.sum() < len(y):
            return self
        bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], axis=1)
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            node, tree = np.zeros(len(y), np.int64), {}
            self._grow(tree, 0, 0, bins, p - y, p * (1 - p), np.arange(len(y)), node)
            self.trees.append(tree)
            margin += self._leaf(tree, node)
        return self

    def _leaf(self, tree: dict, node: np.ndarray) -> np.ndarray:
        value = np.zeros(2 << self.depth)
        for k, v in tree.items():
            if not isinstance(v, tuple):
                value[k] = v
        return value[node]

    def _grow(self, tree: dict, k: int, level: int, bins, g, h, rows, node) -> None:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, -1, 0)
        if level < self.depth:
            for f in range(bins.shape[1]):
                left_g = np.cumsum(np.bincount(bins[rows, f], g[rows], self.cuts + 1))[:-1]
                left_h = np.cumsum(np.bincount(bins[rows, f], h[rows], self.cuts + 1))[:-1]
                right_g, right_h = total_g - left_g, total_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - total_g**2 / (total_h + 1)
                gain[(left_h < self.least) | (right_h < self.least)] = 0
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), f, at)
        if best[1] < 0:
            tree[k] = -self.rate * total_g / (total_h + 1)
            node[rows] = k
            return
        _, f, at = best
        tree[k] = (f, at)
        right = bins[rows, f] > at
        self._grow(tree, 2 * k + 1, level + 1, bins, g, h, rows[~right], node)
        self._grow(tree, 2 * k + 2, level + 1, bins, g, h, rows[right], node)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not self.trees or not len(x):
            return out
        bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], axis=1)
        for tree in self.trees:
            feature, cut, value = np.full(2 << self.depth, -1), np.zeros(2 << self.depth, np.int64), np.zeros(2 << self.depth)
            for k, v in tree.items():
                if isinstance(v, tuple):
                    feature[k], cut[k] = v
                else:
                    value[k] = v
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                right = bins[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += value[node]
        return out


class Isotonic:
    """The best rising function from margins to shares (pool adjacent violators), with lines between the pools' middles."""

    def __init__(self, margin: np.ndarray, y: np.ndarray):
        order = np.argsort(margin, kind="stable")
        pools: list[list[float]] = []  # sum of labels, of margins, count
        for m, label in zip(margin[order].tolist(), y[order].tolist(), strict=True):
            pools.append([label, m, 1])
            while len(pools) > 1 and pools[-2][0] * pools[-1][2] >= pools[-1][0] * pools[-2][2]:
                a = pools.pop()
                pools[-1] = [u + v for u, v in zip(pools[-1], a, strict=True)]
        self.at = np.array([m / n for _, m, n in pools])
        self.share = np.array([(s + 0.02) / (n + 0.04) for s, _, n in pools])

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return 1 / (1 + np.exp(-margin))
        inside = np.interp(margin, self.at, np.maximum.accumulate(self.share))
        # beyond the outermost pools scores keep the order of the margins
        tail = 1e-3 * (np.tanh(margin / 8) + 1) / 2
        return np.clip(inside * (1 - 1e-3) + tail, 0, 1)


def _sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """third (0 to 2), text and label of the sampled labelled rows."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = marked.withColumn("h", F.xxhash64("doc_id", F.lit(7))).orderBy("h", "doc_id").limit(sample)
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    # copies with different labels: the text is what one of them says it is
    return rows.groupBy("text").agg(F.max("y").alias("y")).select(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(3)).alias("third"), "text", "y")


def _key_counts(rows: DataFrame) -> DataFrame:
    """For each key and third, texts of label 0 and 1 that have it; the key "" counts all texts."""

    def batch(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[i] for k in seen], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))] + [pa.array(list(seen.values()), pa.int64())], names=["k", "third", "y", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for third, text, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                seen.update((k, third, y) for k in {k for t in set(text.lower().split()) for k in keys(bare(t))} | {""})
                if len(seen) > 100_000:  # what one task holds; the rest is added up by Spark
                    yield batch(seen)
                    seen = Counter()
        yield batch(seen)

    counts = rows.select(F.col("third").cast("int").alias("third"), "text", "y").mapInArrow(lean(count), "k string, third int, y int, n bigint")
    return settled(counts.groupBy("k", "third").agg(F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1")), "op6-lexicon")


def _lexicon(counts: DataFrame, without: int) -> tuple[frozenset[str], frozenset[str]]:
    """Words and beginnings that mark label 1 strongly, or weakly, in the texts of all thirds but one."""
    summed = counts.where(F.col("third") != without).groupBy("k").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    total = summed.where("k = ''").first()
    if total is None or not total.n1:
        return frozenset(), frozenset()
    share = total.n1 / (total.n0 + total.n1)
    precision = F.col("n1") / (F.col("n0") + F.col("n1"))
    other = F.when(F.col("n0") > 0, F.col("n0") * F.log((1 - precision) / max(1e-9, 1 - share))).otherwise(0)
    evidence = 2 * (F.col("n1") * F.log(precision / share) + other)
    found = summed.where((F.length("k") > 2) & (precision >= 0.5) & (F.col("n1") >= 4)).select("k", precision.alias("p"), evidence.alias("e")).where("e > 28").collect()  # as many as the sample's words at most
    return frozenset(r.k for r in found if r.p >= 0.85), frozenset(r.k for r in found if r.p < 0.85)


def _featured(rows: DataFrame, lexicons: list[tuple]) -> DataFrame:
    """third, y and the features x, by the lexicon of the other thirds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Codes(*x) for x in lexicons]
        for b in batches:
            x = [features(t, own[third]) for third, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(x, pa.list_(pa.float64()))], names=["third", "y", "x"])

    return rows.select(F.col("third").cast("int").alias("third"), "y", "text").mapInArrow(lean(run), "third int, y int, x array<double>")


class Model:
    """A scorer of texts."""

    def __init__(self, codes: tuple, trees: Trees, isotonic: Isotonic):
        self.codes, self.trees, self.isotonic = codes, trees, isotonic

    def scores(self, texts: list[str], codes: Codes) -> np.ndarray:
        x = np.array([features(t or "", codes) for t in texts]).reshape(-1, len(FEATURES))
        return self.isotonic(self.trees.margin(x))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """labels: doc_id and the label, of the rows that may be learned from."""
    rows = settled(_sample(docs, labels, label, sample), "op6")
    counts = _key_counts(rows)
    got = _featured(rows, [_lexicon(counts, k) for k in range(3)]).orderBy("third", "y", "x").collect()
    codes = _lexicon(counts, -1)
    x = np.array([r.x for r in got]).reshape(-1, len(FEATURES))
    y, fit = np.array([r.y for r in got], np.float64), np.array([r.third < 2 for r in got], bool)
    trees = Trees().fit(x[fit], y[fit])
    held = y[~fit]
    both = 0 < held.sum() < len(held)
    return Model(codes, trees, Isotonic(trees.margin(x[~fit]), held) if both else Isotonic(np.empty(0), np.empty(0)))


def _run(shared, names: list[str], text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        codes = Codes(*own.codes)
        for b in batches:
            score = pa.array(own.scores(b.column(b.num_columns - 1).to_pylist(), codes), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[: b.num_columns if text else -1], score], names=names)

    return run


def scores(docs: DataFrame, model: Model, *, keep: list[str], text: str = "text") -> DataFrame:
    """The columns in keep (which need not hold the text), and score. A text goes to Python once, and back only if it is kept."""
    spark = docs.sparkSession
    arrow_bounds(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded: the marking keys of SAMPLE texts and a fixed number of trees
    others = [c for c in keep if c != text]
    source = docs.select(*others, F.col(text).cast("string").alias(text))
    kinds = dict(source.dtypes)
    name = "__score" if "score" in keep else "score"
    back = [*others, text] if text in keep else others
    out = source.mapInArrow(lean(_run(shared, [*back, name], text in keep)), ", ".join([*(f"`{c}` {kinds[c]}" for c in back), f"`{name}` double"]))
    return out.select(*keep, name)


def scored(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of docs, and score (__score if there is one)."""
    return scores(docs, model, keep=docs.columns, text=text)


def learned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """The model of the query and the pipeline: learned from labels of rows outside the held-out fold."""
    return train(docs, table(spark, sf_dir, "labels").where(crc_mod5() != 0))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    docs = table(spark, sf_dir, "documents")
    out = scores(docs, learned(spark, docs, sf_dir), keep=["doc_id"])
    return out.select("doc_id", (crc_mod5() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
