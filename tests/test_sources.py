"""The live source: WebSocket, backoff, recorder, feed, streaming source, settings, and the command line over an archive."""

import base64
import gzip
import hashlib
import json
import random
import socket
import struct
import threading
import time
from datetime import UTC, datetime, timedelta

import pytest

from tideline import cli
from tideline.sources import live, settings
from tideline.sources.archive import read_archive


class Server:
    """A WebSocket server that sends each connection its own list of (kind, data, whether it ends a message)."""

    def __init__(self, sendings):
        self.socket = socket.create_server(("127.0.0.1", 0))
        self.url = f"ws://127.0.0.1:{self.socket.getsockname()[1]}/stream?streams=a@trade"
        self.asked, self.got = [], []
        threading.Thread(target=self._run, args=(sendings,), daemon=True).start()

    def _run(self, sendings):
        for sending in sendings:
            conn, _ = self.socket.accept()
            head = b""
            while b"\r\n\r\n" not in head:
                head += conn.recv(4096)
            self.asked.append(head.decode().splitlines()[0])
            key = next(x.split(": ")[1] for x in head.decode().splitlines() if x.startswith("Sec-WebSocket-Key"))
            accept = base64.b64encode(hashlib.sha1((key + live._KEY).encode()).digest()).decode() if sending is not None else "wrong"
            conn.sendall(f"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Accept: {accept}\r\n\r\n".encode())
            for kind, data, last in sending or []:
                size = bytes([len(data)]) if len(data) < 126 else bytes([126]) + struct.pack(">H", len(data)) if len(data) < 1 << 16 else bytes([127]) + struct.pack(">Q", len(data))
                conn.sendall(bytes([kind | (0x80 if last else 0)]) + size + data)
            conn.settimeout(0.3)
            try:
                self.got.append(conn.recv(4096))
            except TimeoutError:
                self.got.append(b"")
            conn.close()


def test_socket_with_reconnects():
    """Long and cut messages, pings, a close, a broken handshake and an end without a close; each connection begins with a marker."""
    long = "x" * 70_000
    server = Server([[(1, b"one", True), (9, b"hi", True), (1, b"tw", False), (0, b"o", True), (1, long.encode(), True), (8, b"\x03\xe8", True)], None, [(1, "drei é".encode(), True)]])
    waits = []
    got = list(live.frames(lambda: live.WebSocket(server.url, timeout=5), attempts=3, backoff=live.Backoff(draw=random.Random(1)), sleep=waits.append))
    assert got == ["#connected", "one", "two", long, "#connected", "drei é"]
    assert server.asked == ["GET /stream?streams=a@trade HTTP/1.1"] * 3 and len(waits) == 3 and all(0 <= w <= 2**i for i, w in enumerate(waits))
    pong = server.got[0]
    assert pong[0] == 0x8A and bytes(b ^ pong[2 + i % 4] for i, b in enumerate(pong[6:8])) == b"hi"


def test_a_long_connection_resets_the_delay():
    now, backoff = [0.0], live.Backoff(draw=random.Random(0), tries=5)

    def stream():
        for step in (10, 100, 10):
            now[0] += step
            yield str(step)

    assert len(list(live.frames(stream, backoff=backoff, attempts=1, sleep=lambda s: None, clock=lambda: now[0]))) == 4
    assert backoff.tries == 1


def test_recorder(spark, tmp_path):
    """Segments by time and hour, only whole ones seen; what a crash left is closed by the next recorder."""
    root, start = tmp_path / "raw", int(datetime(2025, 1, 1, 22, 59, 58, tzinfo=UTC).timestamp()) * 10**9
    recorder = live.Recorder(root, seconds=3, flush_s=0)
    for i in range(8):
        recorder.write(f"f{i}" if i % 2 else f"f{i}".encode(), start + i * 10**9)
    assert len(list((root / "_open").rglob("*.tsv"))) == 1
    recorder.file.flush()
    seen = [r.payload for r in read_archive(spark, str(root)).orderBy("seq").collect()]
    assert seen == [f"f{i}" for i in range(len(seen))] and 0 < len(seen) < 8
    live.Recorder(root)
    back = read_archive(spark, str(root)).orderBy("seq").collect()
    assert [r.payload for r in back] == [f"f{i}" for i in range(8)] and [r.received_ns for r in back] == [start + i * 10**9 for i in range(8)]
    assert {p.parent.name + "/" + p.name for p in root.rglob("*.tsv.gz")} >= {"2025-01-01/22.tsv.gz", "2025-01-01/23.tsv.gz"}
    ticks = iter(range(100))
    assert live.record((str(i) for i in range(50)), live.Recorder(tmp_path / "short", compressed=False), seconds=7, clock=lambda: next(ticks)) == 6
    assert len(list((tmp_path / "short").rglob("*.tsv"))) == 1


def test_feed():
    """Waits while enough is held, gives frames by index again until they are committed."""
    made = []

    def stream():
        for i in range(10):
            made.append(i)
            yield str(i)

    feed = live.Feed(stream(), most=4)
    time.sleep(0.3)
    assert len(made) == 5 and [p for _, _, p in feed.pull(0, 3)] == ["0", "1", "2"] == [p for _, _, p in feed.pull(0, 3)]
    feed.commit(3)
    time.sleep(0.3)
    assert [i for i, _, _ in feed.pull(3, 100)] == [3, 4, 5, 6]
    feed.commit(7), time.sleep(0.3)
    assert [p for _, _, p in feed.pull(7, 100)] == ["7", "8", "9"] and feed.ended


FEED = None


def one_feed():
    global FEED
    FEED = FEED or live.Feed(f"f{i}" for i in range(25))
    return FEED


def test_streaming_source(spark, tmp_path):
    spark.dataSource.register(live.FrameSource)
    raw = spark.readStream.format("frames").option("feed", "test_sources:one_feed").option("maxframes", "10").load()
    query = raw.writeStream.format("memory").queryName("fed").option("checkpointLocation", str(tmp_path / "c")).start()
    for _ in range(100):
        query.processAllAvailable()
        if spark.table("fed").count() >= 25:
            break
        time.sleep(0.1)
    query.stop()
    assert [r.payload for r in spark.table("fed").orderBy("seq").collect()] == [f"f{i}" for i in range(25)]


def test_settings():
    own = settings.load({"SYMBOLS": " AAA, bbb ,", "WS_BASE": "ws://x", "DEPTH_INTERVAL_MS": "1000"})
    assert own.symbols == ("aaa", "bbb") and own.url == "ws://x/stream?streams=aaa@trade/aaa@depth@1000ms/aaa@bookTicker/bbb@trade/bbb@depth@1000ms/bbb@bookTicker"
    assert settings.load({}) == settings.LiveSettings()
    with pytest.raises(ValueError):
        settings.load({"SYMBOLS": " , "})


def test_command_line(spark, tmp_path, capsys):
    """Replays an archive twice into a store, then asks the store."""
    begin, draw, lines = datetime(2025, 1, 1, tzinfo=UTC), random.Random(0), []
    for i in range(300):
        at = begin + timedelta(milliseconds=400 * i)
        ms = int(at.timestamp() * 1000)
        price = 100 + draw.random()
        data = {"e": "trade", "E": ms, "s": "AAA", "t": i, "p": f"{price:.8f}", "q": "1.5", "T": ms, "m": True} if i % 2 else {"u": i, "s": "AAA", "b": f"{price:.8f}", "B": "1", "a": f"{price + 0.01:.8f}", "A": "1"}
        frame = {"stream": "aaa@trade" if i % 2 else "aaa@bookTicker", "data": data}
        lines.append(f"{int(at.timestamp() * 10**6) * 1000}\t{json.dumps(frame)}\n")
    folder = tmp_path / "raw" / "2025-01-01"
    folder.mkdir(parents=True)
    (folder / "00.tsv.gz").write_bytes(gzip.compress("".join([*lines, "broken\n"]).encode()))
    store, out = str(tmp_path / "store"), []
    for _ in range(2):
        assert cli.main(["replay", str(tmp_path / "raw"), "--store", store]) == 0
        out.append(json.loads(capsys.readouterr().out.strip().splitlines()[-1]))
    assert out[0]["frames"] == 300 and out[0]["n_trade"] == 150 and out[0]["skipped_lines"] == 1 and out[0]["parse_errors"] == 0
    assert out[0]["rows_written"] > 150 and out[1]["rows_written"] == 0 and out[0]["flushes"] >= 2 and out[1]["flushes"] == 0
    assert cli.main(["stats", "--store", store]) == 0 and '"n_rows": 150' in capsys.readouterr().out
    assert cli.main(["explain", "--store", store]) == 0 and "Aggregate" in capsys.readouterr().out
    assert cli.main(["health", "--store", store]) == 1 and "unhealthy" in capsys.readouterr().out
    assert cli.main(["compare", "--store", store, "--out", str(tmp_path / "report.md")]) == 0
    assert (tmp_path / "report.md").read_text().startswith("# Detector comparison")
