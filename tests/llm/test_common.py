"""Joins with single keys of which one may have most of the rows, components of graphs with hubs, and labels of copies."""

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("tideline.llm")

from tideline.llm import common, components, ngram_join, toxicity  # noqa: E402


@pytest.fixture
def narrow(spark, monkeypatch):
    """No table is small, ten rows of a key are many, and Spark joins as it was told."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_meeting_a_hot_key(spark, narrow, how):
    """A third of the rows have one key, some none, and rows repeat; the same rows as of a plain join, and no task has all of the key."""
    draw = random.Random(1)
    rows = [(draw.choice(["hot"] * 3 + [f"k{draw.randint(0, 40)}"] * 5 + [None]), draw.randint(0, 50), {"m": 1}) for _ in range(900)]
    left = spark.createDataFrame(rows, "key string, x int, m map<string,int>")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k3", 3), ("none", 4)], "key string, y int")
    got, want = common.met(left, right, "key", how), left.join(right, "key", how)
    assert got.columns == want.columns
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(want)
    if how == "inner":
        spread = got.where("key = 'hot'").groupBy(F.spark_partition_id()).count()
        assert spread.count() > 1
    assert common.met(left.limit(0), right, "key", how).count() == 0


def test_components_of_hubs(spark, narrow):
    """Stars, a path, self-links and repeated links, against a walk along the links."""
    links = [(0, i) for i in range(1, 80)] + [(i, 500) for i in range(300, 340)] + [(i, i + 1) for i in range(600, 640)] + [(700, 700), (0, 5), (5, 0), (79, 300)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for node in sorted(near):
        todo = [node]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = node
                todo += near[x]
    assert got == want


def test_near_copies_with_a_large_class(spark, narrow):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words)] * 30 + [" ".join([*words, f"x{i}"]) for i in range(25)] + ["other text of some six words", None, ""]
    rows = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.joined(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert all(rows[i] == (0, 54) for i in range(55))
    assert rows[55] == (55, 0) and rows[56] == (56, 0) and rows[57] == (57, 0)


def test_copies_with_different_labels(spark):
    """A text is labelled 1 where any of its rows is, in whatever order they come."""
    docs = spark.createDataFrame([(i, "the same text") for i in range(6)] + [(6, "another")], "doc_id bigint, text string")
    for ones in ([0], [5], [2, 3]):
        labels = spark.createDataFrame([(i, int(i in ones)) for i in range(7)], "doc_id bigint, toxic int").repartition(3)
        got = {r.text: r.y for r in toxicity._sample(docs, labels, "toxic", 100).collect()}
        assert got == {"the same text": 1, "another": 0}
