"""Parts of the corpus operators that need no session, against brute force or exact round trips."""

import math
import random
import re

import numpy as np
import pytest

from tideline.llm import byte_bpe, chunks, decontaminate, media, ngram_join, seating, token_file, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
ALPHABET = "abtheing \n\t  .,'s1é日本🙂\x1c <|endoftext|>ß"


def texts(n, seed=0, most=60):
    draw = random.Random(seed)
    return ["", " ", "a" * 3000 + "thething" * 200] + ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 70_000])
@pytest.mark.parametrize("high", [1, 300, 50_257, 2**32 - 1])
def test_blocks_round_trip(n, high):
    draw = np.random.default_rng(n)
    x = np.where(draw.random(n) < 0.95, draw.integers(0, min(high, 200), n), draw.integers(0, high, n)).astype(np.uint32)
    data = token_file.pack(x)
    assert (token_file.unpack(data) == x).all()
    if n:
        s, c = int(draw.integers(0, n)), int(draw.integers(0, n))
        c = min(c, n - s)
        assert (token_file.unpack_from(data, s, c) == x[s : s + c]).all()


#: Texts with added tokens, and with blanks and line ends in all places.
ODD = ["a\0b, c", "hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>", "x <| y", " ", "a b\n", "a b\n\n", "\na", "a\n\nb", "a\n\n\nb", "\tfoo a", "a \nb", "a\n b", "x,\ny. z", "l'eau. d'une, it's, don't.", "ab,.", "日本.", "\u2028a\u2028b", "a\r\nb"]


@pytest.mark.parametrize("size", [3, 100_000])
def test_encoder_gives_what_the_library_gives(size):
    """Also where little is remembered, and for texts beside others that are new."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, encode, draw = Tokenizer.from_file(path), token_file.Library(path, size=size), random.Random(size)
    lines = ["".join(draw.choice("ab,. \n") for _ in range(draw.randint(0, 40))) for _ in range(300)]
    for some in (ODD, texts(500), lines, [""], ["word " * 20_000, "w" * 20_000]):
        ids, sizes = encode(pa.array(some), b"\x02\0\0\0")
        at = 0
        for t, n in zip(some, sizes.tolist(), strict=True):
            assert ids[at : at + n].tolist() == [*own.encode(t, add_special_tokens=False).ids, 2]
            at += n
        assert at == len(ids)
    ids, _ = encode(pa.array(ODD[1:2]), b"\x02\0\0\0")
    assert ids.tolist() == [31373, 220, 50256, 995, 2]


class Upper(chunks.Parts):
    line = b"\n\n\n\n"

    def encode(self, texts):
        self.asked += len(texts)
        return [b"".join(c.encode("utf-32-le") for c in t.upper()) for t in texts]


def test_parts_join_to_the_text_and_stay_bounded():
    import pyarrow as pa

    own = Upper(size=50)
    own.asked = 0
    for at in range(0, 2000, 40):
        some = texts(2000)[at : at + 40] + ["alpha beta, gamma.\nalpha"]
        ids, sizes = own(pa.array(some))
        assert len(own.old) <= 50 + 4000 and sizes.sum() == len(ids)
        ends = np.cumsum(sizes)
        for t, s, e in zip(some, ends - sizes, ends, strict=True):
            got = ids[s:e].tobytes().replace(b"\n\n\n\n", "\n".encode("utf-32-le"))
            assert got.decode("utf-32-le") == t.upper()
    known = own.asked
    own(pa.array(["alpha beta, gamma.\nalpha"]))
    assert own.asked == known


def test_batches_are_put_together(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(chunks, "GATHER", 300)
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array(["x" * 100])], names=["i", "t"]) for i in range(7)]
    got = [c[0].to_pylist() for c in chunks.together(iter(batches))]
    assert [x for g in got for x in g] == list(range(7)) and 1 < len(got) < 7


def test_batches_that_are_too_large_are_cut():
    import pyarrow as pa

    sizes = [50] * 90 + [5000] + [0] * 20 + [50] * 90
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array(["x" * n for n in sizes])], names=["i", "t"])
    got = list(chunks.together(iter([batch.slice(0, 150), batch.slice(150)]), 1000))
    assert [x for g in got for x in g[0].to_pylist()] == list(range(len(sizes)))
    assert [len(x) for g in got for x in g[1].to_pylist()] == sizes
    bytes_ = [sum(c.nbytes for c in g) for g in got]
    assert sorted(bytes_)[-2] < 2000 and max(bytes_) < 5000 + 2000


@pytest.mark.parametrize("size", [3, 100_000])
def test_bpe_equals_the_library(size):
    import pyarrow as pa

    tiktoken = pytest.importorskip("tiktoken")
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, size=size)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    for some in (ODD, texts(1500, seed=3), [""], ["word " * 20_000 + "x"]):
        ids, sizes = bpe(pa.array(some))
        at = 0
        for t, n in zip(some, sizes.tolist(), strict=True):
            assert ids[at : at + n].tolist() == own.encode_ordinary(t) == bpe.ids(t)
            assert bpe.decode(ids[at : at + n].tolist()) == t.encode()
            at += n


def test_wav_and_fingerprint():
    for data in (b"", b"x", bytes(range(256)) * 30):
        p = media.padded(data)
        assert len(p) % 576 == 0 and len(p) > 0 and p.startswith(data) and set(p[len(data) :]) <= {255}
        assert media.from_wav(media.to_wav(p)) == p
    t = np.arange(576 * 20)
    tone = (128 + 100 * np.sin(2 * np.pi * t * 40 / 576)).astype(np.uint8).tobytes()
    marks = media.fingerprint(tone)
    assert len(marks) and (np.diff(marks) >= 0).all()
    assert 40 in set(((marks >> 20) & 0xFFF).tolist())


def test_windows_against_brute_force():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(6)]
    items = [(str(i), " ".join(draw.choices(vocabulary, k=draw.choice([0, 1, 3, 5, 8]))).encode()) for i in range(12)]
    for _ in range(60):
        doc = draw.choices(vocabulary, k=draw.randint(0, 40))
        words = [w.encode() for w in doc]
        index = decontaminate.Index(items, {w: 1 + words.count(w) for w in words}, size=4)
        hits, found = index.find(words)
        want_hit, want_items = set(), set()
        for item, text in items:
            w = text.decode().split()
            for i in range(max(1, len(w) - 3)) if w else ():
                window = w[i : i + 4]
                for j in range(len(doc) - len(window) + 1):
                    if doc[j : j + len(window)] == window:
                        want_hit.update(range(j, j + len(window)))
                        want_items.add(item)
        assert {p for s, e in decontaminate.merged(hits) for p in range(s, e)} == want_hit
        assert found == want_items


def test_words_are_those_of_the_contract():
    text = "Ab_c-D9 é日本x\x00Ü, ÀB"
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    assert [w.decode() for w in decontaminate.words(text.encode())] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_pruning_keeps_near_pairs():
    draw = np.random.default_rng(0)
    for similarity, kept in ((0.8, True), (0.9, True), (0.3, False)):
        n = 3000
        both = int(n * similarity)
        base = draw.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
        a, b = ngram_join.minhashes(base[:n]), ngram_join.minhashes(np.concatenate([base[:both], base[n:]]))
        a, b = ((m >> np.uint64(40)).astype(np.uint8) for m in (a, b))
        real = both / (2 * n - both)
        assert bool(ngram_join.may_reach(a[None], b, real if kept else 0.8)[0]) is kept


def test_no_link_is_lost_in_a_bucket():
    """Rows at all distances from each other: those that differ in at most D bytes hang together, in one pass or two."""
    import pyarrow as pa

    draw = np.random.default_rng(8)
    d = ngram_join.HASHES - ngram_join.least_matches(ngram_join.THRESHOLD)[-1]
    rows = [draw.integers(0, 256, ngram_join.HASHES).astype(np.uint8)]
    for _ in range(250):
        row = rows[draw.integers(0, len(rows))].copy()
        at = draw.permutation(len(row))[: draw.integers(1, d + 8)]
        row[at] = draw.integers(0, 256, len(at))
        rows.append(row)
    nodes = [i.to_bytes(4, "big") for i in range(len(rows))]
    parts = draw.integers(0, 3, len(rows))

    def links(salts, close, far, some):
        order = sorted(some, key=lambda i: (salts[i] if salts is not None else 0, nodes[i]))
        columns = [pa.array([1] * len(order)), *([pa.array([int(salts[i]) for i in order], pa.int32())] if salts is not None else []), pa.array([nodes[i] for i in order], pa.binary()), pa.array([rows[i].tobytes() for i in order], pa.binary())]
        names = ["key", *(["salt"] if salts is not None else []), "node", "signature"]
        batch = pa.RecordBatch.from_arrays(columns, names=names)
        got = list(ngram_join._linked(close, far)(iter([batch.slice(0, 100), batch.slice(100)])))
        return [(int.from_bytes(r["a"], "big"), int.from_bytes(r["b"], "big")) for b in got for r in b.to_pylist()]

    c, s = ngram_join.CLOSE, ngram_join.SPLIT_CLOSE
    whole = links(np.full(len(rows), -1), (c, s), (d + c, d + s), range(len(rows)))
    first = links(parts, (c, s), (d + c, d + s), range(len(rows)))
    second = links(None, (s, s), (d + 3 * s,) * 2, [a for a, b in first if a == b])
    for found in (whole, first + second):
        sets = ngram_join._Sets(len(rows))
        for a, b in found:
            sets.join(a, b)
        assert all(sets.top(i) == sets.top(j) for i in range(len(rows)) for j in range(i) if (rows[i] != rows[j]).sum() <= d)


def test_shingles():
    assert len(ngram_join.shingles(b"")) == 0 == len(ngram_join.shingles(b"!!! ..."))
    assert len(ngram_join.shingles(b"one two")) == 1
    assert (ngram_join.shingles(b"One, two three four five six") == ngram_join.shingles("one two THREE four five six".encode())).all()
    assert len(ngram_join.shingles(b"a b c d e f")) == 2


def test_seating():
    draw = np.random.default_rng(0)
    c = np.array([1, 2, 5, 1000, 100_000])
    t = np.mean([seating.tables(c, np.full(5, 0.5), 0.5, draw) for _ in range(200)], axis=0)
    assert t[0] == 1 and (t >= 1).all() and (t <= c).all() and (np.diff(t) >= 0).all()
    assert len(seating.tables(np.empty(0, int), np.empty(0), 0.5, draw)) == 0


def stirling(most, d):
    """log S(c, t) for all c up to most: the numbers of seatings of c customers at t tables, by the next customer's choices."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, most):
        for t in range(1, c + 1):
            out[c + 1, t] = np.logaddexp(out[c + 1, t], out[c, t] + math.log(c - d * t))
            out[c + 1, t + 1] = np.logaddexp(out[c + 1, t + 1], out[c, t])
    return out


@pytest.mark.parametrize("c,a,d", [(6, 1.3, 0.4), (6, 0.01, 0.9), (50, 3.0, 0.4), (50, 40.0, 0.7), (400, 3.0, 0.4), (400, 0.2, 0.8), (400, 15.0, 0.3), (400, 60.0, 0.6), (400, 500.0, 0.5)])
def test_seating_against_the_exact_distribution(c, a, d):
    """P(t tables | c customers) is in proportion to a ** t S(c, t); as production draws it."""
    t = np.arange(1, c + 1)
    weight = t * math.log(a) + stirling(c, d)[c, 1:]
    weight = np.exp(weight - weight.max())
    weight /= weight.sum()
    mean = (weight * t).sum()
    deviation = math.sqrt((weight * t * t).sum() - mean**2)
    got = seating.tables(np.full(40_000, c), np.full(40_000, a), d, np.random.default_rng(1))
    assert got.mean() == pytest.approx(mean, abs=0.02 * deviation + 0.5 * (a > 20 and c > 256) + 0.02)
    assert got.std() == pytest.approx(deviation, rel=0.05, abs=0.02)
    if c <= 50:
        assert np.bincount(got, minlength=c + 1)[1:] / len(got) == pytest.approx(weight, abs=0.012)


def test_seating_where_tables_draw_tables():
    """With a dish alone in its restaurant, opening grows with its own tables: a (a + step) ... S(c, t)."""
    c, a, d = 30, 0.6, 0.5
    t = np.arange(1, c + 1)
    weight = np.cumsum(np.log(a + d * 0.3 * np.arange(c))) + stirling(c, d)[c, 1:]
    weight = np.exp(weight - weight.max())
    got = seating.tables(np.full(20_000, c), np.full(20_000, a), d, np.random.default_rng(2), step=d * 0.3)
    assert got.mean() == pytest.approx((weight * t).sum() / weight.sum(), abs=0.05)


def test_isotonic_rises():
    draw = np.random.default_rng(0)
    m = draw.normal(size=500)
    y = (draw.random(500) < 1 / (1 + np.exp(-3 * m))).astype(float)
    p = toxicity.Isotonic(m, y)(np.linspace(-5, 5, 200))
    assert (np.diff(p) > 0).all() and p.min() >= 0 and p.max() <= 1


def test_trees_learn():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(800, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = toxicity.Trees(rounds=60).fit(x[:600], y[:600])
    assert ((t.margin(x[600:]) > 0) == (y[600:] > 0)).mean() > 0.93
    assert toxicity.Trees().fit(np.empty((0, 3)), np.empty(0)).margin(np.zeros((2, 3))).shape == (2,)
