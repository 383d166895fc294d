"""The prefix trie against plain counting, in small pieces and blocks, and against its SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

duckdb = pytest.importorskip("duckdb")
import numpy as np  # noqa: E402

from tideline.llm import prefix_trie  # noqa: E402

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """All nodes, by following every prefix of every conversation."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(str(c) for c in sorted(convs) if len(full[c]) == len(node))
        kids = sum(len(x) == len(node) + 1 for x in below)
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), kids, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def drawn(seed, convs, most, words):
    draw, rows = random.Random(seed), []
    for c in draw.sample(range(3 * convs), convs):
        said = [(draw.choice(["user", "bot", None]), draw.choice(words)) for _ in range(draw.randint(0, most))]
        order = list(range(len(said)))
        rows += [(c, t if t or draw.random() < 0.5 else None, r, x, 7) for t, (r, x) in zip(order, said, strict=True)]
    draw.shuffle(rows)
    return rows


def got(spark, rows, **sizes):
    turns = prefix_trie.rebuilt(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted((tuple(r) for r in prefix_trie.trie(turns, **sizes).select(*NAMES).collect()), key=str)


@pytest.mark.parametrize("sizes", [{"width": 64, "block": 16}, {"width": 3, "block": 4}, {"width": 2, "block": 1}])
def test_trie_counts_every_prefix(spark, sizes):
    rows = drawn(sizes["width"], 40, 9, ["a", "a", "b", None, "é"])
    rows += [(3, None, None, None, 0), (None, 1, "user", "lost", 0), (-7, 0, "user", "a", 0), (-5, 2, "user", "a", 0), (-5, 2, "bot", "b", 0), (-5, 2, "bot", "b", 0)]
    assert got(spark, rows, **sizes) == plain(rows)


def test_hot_prefix_copies_and_a_very_long_conversation(spark):
    hot = [(5 * c, t, "user", f"same {t}", 0) for c in range(40) for t in range(12)]
    long = [(c, t, "user", f"t{t % 7}", 0) for c in (1000, 1005, 1010) for t in range(300 if c < 1010 else 130)]
    one = [(2001, 0, "user", "x" * 2_000_000, 0)]
    assert got(spark, hot + long + one, width=8, block=7) == plain(hot + long + one)


def test_nothing_and_turnless(spark):
    assert got(spark, []) == []
    # 1 has a head of several turns and no first conversation
    assert zlib.crc32(b"1") % 9 > 1
    assert got(spark, [(1, 0, "user", "a", 0)]) == plain([(1, 0, "user", "a", 0)])


def test_nearest_smaller():
    draw = random.Random(4)
    for _ in range(50):
        v = [draw.randint(-1, 4) for _ in range(draw.randint(1, 30))]
        left, right, lead = prefix_trie.nearest_smaller(np.array(v))
        for i, x in enumerate(v):
            smaller = [j for j in range(i) if v[j] < x]
            assert left[i] == (smaller[-1] if smaller else -1)
            assert right[i] == next((j for j in range(i, len(v)) if v[j] < x), len(v))
            assert lead[i] == (x not in v[left[i] + 1 : i])


def test_sql_agrees(spark, tmp_path):
    rows = drawn(9, 60, 11, ["a", "b", "b", "été"])
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(prefix_trie.OP11_SQL)
    names = [c[0] for c in want.description]
    df = prefix_trie.op11_prefix_trie(spark, str(tmp_path))
    assert sorted(map(str, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(str, want.fetchall()))
