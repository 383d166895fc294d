"""Shuffles into shards: exact sizes, the matrix's law, bijections, and even spread."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tideline.llm import sharding
from tideline.llm.common import settled

SCHEMA = "doc_id bigint, text string, shard string, law int"


def checked(rows, shards):
    """Counts at most one apart, slots gapless from 0."""
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(by.get(i, [])) for i in range(shards)]
    assert max(counts) - min(counts) <= 1 and all(sorted(by[i]) == list(range(len(by[i]))) for i in by)


def test_query(spark, tmp_path):
    rows = [(i, f"text {i % 50} é", "x", 1) for i in range(1003)] + [(None, None, None, None), (None, "", None, 2), (5, "x" * 3_000_000, "y", 0)] + [(7, "same", "z", 3)] * 500
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    out = sharding.op12_sharding(spark, str(tmp_path))
    found = out.collect()
    checked(found, 40)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    assert {(r["law"], r["grown_shard"]) for r in found} == {("rows", None)}
    again = sharding.op12_sharding(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_rows_than_shards(spark, tmp_path, n):
    spark.createDataFrame([(i, "t", "x", 1) for i in range(n)], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = sharding.op12_sharding(spark, str(tmp_path)).collect()
    assert len(found) == n and {r["slot"] for r in found} <= {0} and len({r["shard"] for r in found}) == n


def test_small_parts_deep_trees_and_all_columns(spark, monkeypatch):
    """Parts of 4 rows and nodes of 4 children: matrix, permutations and slots go over many levels, with and without a broadcast."""
    monkeypatch.setattr(sharding, "PART", 2)
    monkeypatch.setattr(sharding, "FAN", 2)
    df = spark.range(0, 90, 1, 5).selectExpr("id", "id * 2 as twice", "'a' as slot")
    parts = settled(df.groupBy((sharding.F.col("id") / 7).cast("bigint").alias("part")).count().withColumnRenamed("count", "rows"), "t")
    matrix = sorted(sharding.communication_matrix(parts, [30, 40, 20], 3).collect())
    assert [sum(r["counts"]) for r in matrix] == [r["rows"] for r in sorted(parts.collect())]
    assert [sum(c) for c in zip(*(r["counts"] for r in matrix), strict=True)] == [30, 40, 20]
    before = [0, 0, 0]
    for r in matrix:
        assert r["begins"] == before
        before = [a + b for a, b in zip(before, r["counts"], strict=True)]
    found = sharding.shuffled(df, 7).collect()
    checked(found, 7)
    assert sorted((r["id"], r["twice"]) for r in found) == [(i, 2 * i) for i in range(90)]


def test_shuffle_join_and_seeds(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BROADCAST_COUNTS", 0)
    df = spark.range(0, 3000, 1, 6).selectExpr("id", "id % 2 as slot")
    found = {s: sharding.shuffled(df, 7, seed=s).collect() for s in (1, 2)}
    for rows in found.values():
        checked(rows, 7)
        assert sorted(r["id"] for r in rows) == list(range(3000))
    assert sum(a == b for a, b in zip(sorted(found[1]), sorted(found[2]), strict=True)) < 50


def test_spread_is_even(spark):
    """Over many seeds every row falls into every shard equally often, and neighbours don't stay together."""
    df = settled(spark.range(0, 24, 1, 4), "t")
    runs = 20
    seen, pairs = Counter(), 0
    for seed in range(runs):
        rows = {r["id"]: (r["shard"], r["slot"]) for r in sharding.shuffled(df, 4, seed=seed).collect()}
        seen.update((i, s) for i, (s, _) in rows.items())
        pairs += sum(rows[i][0] == rows[i + 1][0] for i in range(23))
    # chi squared of 24 * 4 cells with (24 - 1) * (4 - 1) degrees of freedom, five deviations
    chi = sum((seen[i, s] - runs / 4) ** 2 / (runs / 4) for i in range(24) for s in range(4))
    assert abs(chi - 69) < 5 * math.sqrt(2 * 69)
    share, n = 5 / 23, 23 * runs
    assert abs(pairs - n * share) < 5 * math.sqrt(n * share * (1 - share))


@pytest.mark.parametrize("good,bad,taken", [(3, 4, 5), (10, 0, 4), (0, 10, 4), (50, 200, 100), (5, 5, 10), (1000, 30, 40)])
def test_hypergeometric(good, bad, taken):
    rng, runs = np.random.default_rng(5), 20_000
    seen = Counter(sharding.hypergeometric(rng, good, bad, taken) for _ in range(runs))
    for k in range(max(0, taken - bad), min(good, taken) + 1):
        p = math.comb(good, k) * math.comb(bad, taken - k) / math.comb(good + bad, taken)
        assert abs(seen[k] - runs * p) <= 5 * math.sqrt(runs * p * (1 - p)) + 1
    assert sum(seen.values()) == runs and set(seen) <= set(range(max(0, taken - bad), min(good, taken) + 1))


def test_hypergeometric_of_very_many():
    rng = np.random.default_rng(6)
    drawn = [sharding.hypergeometric(rng, 10**11, 39 * 10**11, 10**8) for _ in range(400)]
    sd = math.sqrt(10**8 / 40 * 39 / 40)
    assert abs(np.mean(drawn) - 10**8 / 40) < 5 * sd / 20 and 0.8 * sd < np.std(drawn) < 1.2 * sd


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 65_537])
def test_bijection(size):
    out = sharding.bijection(np.arange(size), size, 1, 2)
    assert sorted(out.tolist()) == list(range(size))
    if size >= 1000:
        assert abs(np.corrcoef(np.arange(size), out)[0, 1]) < 5 / math.sqrt(size)
