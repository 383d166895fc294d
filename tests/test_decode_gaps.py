"""Decoding of frames and archives, and gaps in the depth sequence."""

import gzip
import json
import random
from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tideline.functions import decode, running
from tideline.operators.gaps import detect_gaps
from tideline.sources.archive import decoded_lines, read_archive, read_recording, write_archive, write_recording

T0 = datetime(2031, 3, 14, 7, 5, 9, tzinfo=UTC)
MS = int(T0.timestamp() * 1000)


def trade(price="7.5", qty="3", s="AAA", t=1):
    return json.dumps({"stream": f"{s.lower()}@trade", "data": {"e": "trade", "E": MS + 41, "s": s, "t": t, "p": price, "q": qty, "T": MS + 38, "m": True, "M": True}})


def depth(first, last, s="AAA"):
    return json.dumps({"stream": f"{s.lower()}@depth@100ms", "data": {"e": "depthUpdate", "E": MS + 41, "s": s, "U": first, "u": last, "b": [["7.25", "4"]], "a": []}})


def quote(bid="7.4", ask="7.6", s="AAA"):
    return json.dumps({"stream": f"{s.lower()}@bookTicker", "data": {"u": 7, "s": s, "b": bid, "B": "1", "a": ask, "A": "2"}})


def raw(spark, payloads):
    return spark.createDataFrame([(i, T0 + timedelta(milliseconds=i), p) for i, p in enumerate(payloads)], "seq long, received_at timestamp, payload string")


def spoiled(frame, needed):
    """Frames that lack one of the needed fields of data, or have something of another kind there, or lack an outer part."""
    whole = json.loads(frame)
    for name in needed:
        rest = {k: v for k, v in whole["data"].items() if k != name}
        yield json.dumps(whole | {"data": rest})
        yield json.dumps(whole | {"data": rest | {name: None}})
        if name not in ("s", "e"):
            yield json.dumps(whole | {"data": rest | {name: "?"}})
    for part in whole:
        yield json.dumps({k: v for k, v in whole.items() if k != part})
    yield json.dumps(whole | {"data": list(whole["data"])})
    yield frame[:-1]
    yield frame[1:]


def test_statuses(spark):
    needed = {trade(): "eEstpqTm", depth(1, 2): "eEsUuba", quote(): "usbBaA"}
    bad = [b for frame, names in needed.items() for b in spoiled(frame, names)] + [" ", "[]", "7"]
    good = [*needed, '{"stream":"aaa@kline_1m","data":{"e":"kline"}}', "#connected", "#" * 3]
    got = [r.status for r in decode.decoded(raw(spark, good + bad)).orderBy("seq").collect()]
    assert got[: len(good)] == ["trade", "depth", "quote", "other", "marker", "comment"]
    assert {b: g for b, g in zip(bad, got[len(good) :], strict=True) if g != "error"} == {}


def test_fields(spark):
    """Prices and quantities of eight places are kept exactly."""
    draw = random.Random(2)
    prices = [Decimal(draw.randint(1, 10**13)).scaleb(-8) for _ in range(20)]
    records = decode.typed(decode.decoded(raw(spark, [*(trade(price=f"{p:f}", t=i) for i, p in enumerate(prices)), depth(5, 9), quote("7.4", "7.6"), quote("0", "0")])))
    assert decode.quotes(records).count() == 1
    ts = decode.trades(records).orderBy("seq").collect()
    assert [t.price for t in ts] == prices and [t.trade_id for t in ts] == list(range(20))
    assert all(t.buyer_is_maker and t.time.microsecond == 38000 and t.event_time.microsecond == 41000 for t in ts)
    d, q = decode.depth(records).first(), decode.quotes(records).first()
    assert (d.first_update_id, d.final_update_id, d.bids, d.asks) == (5, 9, [["7.25", "4"]], [])
    assert (q.update_id, q.bid, q.ask_qty) == (7, Decimal("7.4"), 2)


def account(payloads):
    """Gaps by plain steps: what each symbol's last update was, and whether a connection has begun since then that wasn't the first."""
    last, connected, again, out = {}, False, set(), []
    for p in payloads:
        if p == "#connected":
            again = set(last) if connected else again
            connected = True
        elif '"depthUpdate"' in p:
            d = json.loads(p)["data"]
            if d["s"] in last and d["U"] != last[d["s"]] + 1:
                out.append((d["s"], last[d["s"]], d["U"], d["U"] - last[d["s"]] - 1, "reconnect" if d["s"] in again else "stream"))
            last[d["s"]] = d["u"]
            again.discard(d["s"])
    return out


def streams(seed, n):
    """Updates of three symbols that mostly follow on each other, with holes, repeats, overlaps and connections."""
    draw, at, out = random.Random(seed), {}, []
    for _ in range(n):
        if draw.random() < 0.12:
            out.append(draw.choice(["#connected", "#connected", "#note", quote()]))
            continue
        s = draw.choice(["AAA", "BBB", "CCC"])
        first = at.get(s, draw.randint(1, 900)) + 1 + draw.choice([0] * 6 + [1, 7, 45, -1, -13])
        at[s] = first + draw.randint(0, 30)
        out.append(depth(first, at[s], s))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("rows", [None, 17])
def test_gaps_against_plain_steps(spark, seed, rows, monkeypatch):
    """Also where the rows are cut into pieces: what a piece needs of those before it is carried over."""
    if rows:
        monkeypatch.setattr(running, "PIECE", rows)
    payloads = streams(seed, 90)
    records = decode.typed(decode.decoded(raw(spark, payloads)))
    got = detect_gaps(decode.depth(records), decode.markers(records)).orderBy("seq").collect()
    assert [(r.symbol, r.prev_final_update_id, r.first_update_id, r.missing_update_ids, r.cause) for r in got] == account(payloads)


def test_no_updates_no_gaps(spark):
    records = decode.typed(decode.decoded(raw(spark, ["#connected", trade()])))
    assert detect_gaps(decode.depth(records), decode.markers(records)).count() == 0


def test_malformed_lines(spark):
    lines = ["1931238309000000000\tok", "no tab", "\tx", "12x\ty", "5\t", "7\ta\tb"]
    got = decoded_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.received_ns, r.payload) for r in got] == [(1931238309000000000, "ok"), (7, "a\tb")]


def test_skipped_lines_are_counted(spark, tmp_path):
    path = tmp_path / "2031-03-14" / "07.tsv"
    path.parent.mkdir()
    path.write_text("5000\ta\nno tab\n\tx\n7000\tb\n99999999999999999999\tc\n")
    skipped = Observation()
    rows = read_archive(spark, str(tmp_path), skipped=skipped)
    assert [r.payload for r in rows.orderBy("seq").collect()] == ["a", "b"]
    assert skipped.get["n"] == 3


def merged(files):
    """The archive's order by plain steps: hour by hour, the file whose next line is the earliest gives it; ties go to the path."""
    out = []
    for hour in sorted({h for _, h, _ in files}):
        heads = [(path, list(rows)) for path, h, rows in sorted(files) if h == hour]
        while any(rows for _, rows in heads):
            path, rows = min((x for x in heads if x[1]), key=lambda x: (x[1][0][0], x[0]))
            out.append(rows.pop(0)[1])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_archive_order(spark, tmp_path, seed):
    """Several folders with the same hours, clocks that go back, plain and packed files."""
    draw, files = random.Random(seed), []
    for root in "ab":
        for hour in ("2031-03-14/23", "2031-03-15/00"):
            now, rows = 1_790_000_000_000_000_000, []
            for k in range(draw.randint(0, 12)):
                now += draw.choice([0, 1000, 5000, -3000])
                rows.append((now, f"{root}{hour[-2:]}-{k}"))
            path = tmp_path / root / f"{hour}.tsv"
            path.parent.mkdir(parents=True, exist_ok=True)
            text = "".join(f"{ns}\t{p}\n" for ns, p in rows)
            if draw.random() < 0.5:
                path = path.with_suffix(".tsv.gz")
                path.write_bytes(gzip.compress(text.encode()))
            else:
                path.write_text(text)
            files.append((str(path), hour, rows))
    got = read_archive(spark, str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "a"), files[0][0], str(tmp_path)).orderBy("seq").collect()
    # a file gives a line once those before it are given: merge by the running maximum
    rising = [(p, h, [(max(x for x, _ in rows[: i + 1]), v) for i, (_, v) in enumerate(rows)]) for p, h, rows in files]
    assert [r.payload for r in got] == merged(rising)


def test_explicit_files_of_any_name(spark, tmp_path):
    odd, other = tmp_path / "capture.log", tmp_path / "x" / "07.txt"
    other.parent.mkdir()
    odd.write_text("2000\tb\n"), other.write_text("1000\ta\n")
    assert sorted(r.payload for r in read_archive(spark, str(odd), str(other), str(odd)).collect()) == ["a", "b"]


def test_archive_round_trip(spark, tmp_path):
    """What is written is read back: order, nanoseconds, hours, tabs in payloads; a second batch adds to it."""
    ns = 1_790_942_399_123_456_789
    rows = [(i, ns + 400_000_000 * i, p) for i, p in enumerate(["a", "#connected", "b\tc", "d", "e"])]
    frames = spark.createDataFrame(rows, "seq long, received_ns long, payload string").withColumn("received_at", F.timestamp_micros(F.expr("received_ns div 1000")))
    assert write_archive(frames, str(tmp_path / "out")) == 2
    back = read_archive(spark, str(tmp_path / "out")).orderBy("seq").collect()
    assert [(r.received_ns, r.payload) for r in back] == [(r[1], r[2]) for r in rows]
    write_archive(raw(spark, ["later"]), str(tmp_path / "out"), compressed=False)
    again = read_archive(spark, str(tmp_path / "out")).orderBy("seq").collect()
    assert len(again) == 6 and {r.received_at for r in again} >= {T0.replace(tzinfo=None)}
    write_recording(frames, str(tmp_path / "recording"))
    assert sorted(r.payload for r in read_recording(spark, str(tmp_path / "recording")).collect()) == sorted(r[2] for r in rows)
