"""The live source: a WebSocket that reconnects with full-jitter backoff, a recorder of its frames, and a streaming source.

A recorder writes frames to archive files that are complete when they get their name, so `readStream` over the archive, a
replay and the backfill of an outage all read the same files. Where seconds of delay are too many, FrameSource reads a feed
in memory directly.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import logging
import os
import random
import shutil
import socket
import ssl
import struct
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

MARKER = "#connected"
_KEY = "258EAFA5-E914-47DA-95CA-C5AB0DC85B11"  # fixed by RFC 6455

log = logging.getLogger("tideline.live")


@dataclass
class Backoff:
    """Delays drawn from 0 to base, twice base and so on up to cap seconds."""

    base: float = 1.0
    cap: float = 60.0
    draw: random.Random = field(default_factory=random.Random)
    tries: int = 0

    def ceiling(self) -> float:
        return min(self.cap, self.base * 2.0 ** min(self.tries, 32))

    def next_delay(self) -> float:
        delay = self.draw.uniform(0, self.ceiling())
        self.tries += 1
        return delay

    def reset(self) -> None:
        self.tries = 0


def frames(connect: Callable[[], Iterable[str]], *, backoff: Backoff | None = None, healthy_s: float = 60.0, sleep=time.sleep, clock=time.monotonic, attempts: int | None = None) -> Iterator[str]:
    """Frames of one connection after another, each begun by a marker. A connection that is up for over healthy_s resets the delay."""
    backoff, made = backoff or Backoff(), 0
    while attempts is None or made < attempts:
        made, began = made + 1, clock()
        try:
            stream = connect()
            began = clock()
            yield MARKER
            for frame in stream:
                yield frame
                if backoff.tries and clock() - began > healthy_s:
                    backoff.reset()
        except OSError as error:
            log.warning("connection lost: %s", error)
        delay = backoff.next_delay()
        log.info("attempt %d ended; the next in %.1f s", made, delay)
        sleep(delay)


class WebSocket:
    """Text messages of a WebSocket (RFC 6455), as an iterable; pings are answered, and an end of the connection ends it."""

    def __init__(self, url: str, timeout: float = 30.0):
        where = urlsplit(url)
        secure = where.scheme == "wss"
        self.socket = socket.create_connection((where.hostname, where.port or (443 if secure else 80)), timeout)
        if secure:
            self.socket = ssl.create_default_context().wrap_socket(self.socket, server_hostname=where.hostname)
        key = base64.b64encode(os.urandom(16)).decode()
        path = (where.path or "/") + (f"?{where.query}" if where.query else "")
        lines = [f"GET {path} HTTP/1.1", f"Host: {where.netloc}", "Upgrade: websocket", "Connection: Upgrade", f"Sec-WebSocket-Key: {key}", "Sec-WebSocket-Version: 13", "", ""]
        self.socket.sendall("\r\n".join(lines).encode())
        self.file = self.socket.makefile("rb")
        status, headers = self.file.readline(), {}
        while (line := self.file.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("latin-1").partition(":")
            headers[name.strip().lower()] = value.strip()
        want = base64.b64encode(hashlib.sha1((key + _KEY).encode()).digest()).decode()
        if b" 101 " not in status or headers.get("sec-websocket-accept") != want:
            self.close()
            raise ConnectionError(f"no WebSocket: {status.decode('latin-1').strip()}")

    def _read(self, n: int) -> bytes:
        data = self.file.read(n)
        if len(data) < n:
            raise ConnectionError("the connection ended")
        return data

    def _send(self, kind: int, data: bytes) -> None:
        mask = os.urandom(4)
        size = bytes([0x80 | len(data)]) if len(data) < 126 else bytes([0x80 | 126]) + struct.pack(">H", len(data))
        self.socket.sendall(bytes([0x80 | kind]) + size + mask + bytes(b ^ mask[i % 4] for i, b in enumerate(data)))

    def __iter__(self) -> Iterator[str]:
        whole = b""
        while True:
            head, size = self._read(2)
            size &= 0x7F
            if size >= 126:
                size = int.from_bytes(self._read(2 if size == 126 else 8), "big")
            data, kind = self._read(size), head & 0x0F
            if kind == 8:
                self._send(8, data[:2])
                self.close()
                return
            if kind == 9:
                self._send(10, data)
            elif kind in (0, 1, 2):
                whole += data
                if head & 0x80:
                    yield whole.decode()
                    whole = b""

    def close(self) -> None:
        self.socket.close()


class Recorder:
    """Archive files below root: a segment every `seconds`, or when the hour of receipt ends.

    A segment is written as `<root>/_open/...` and moved to `<root>/<segment>/YYYY-MM-DD/HH.tsv[.gz]` when it is complete. What a
    crash leaves below _open is closed as segments by the next Recorder.
    """

    def __init__(self, root: str | Path, *, seconds: float = 10.0, flush_s: float = 1.0, compressed: bool = True, clock=time.time_ns):
        self.root, self.seconds, self.flush_s, self.compressed, self.clock = Path(root), seconds, flush_s, compressed, clock
        self.file, self.path, self.hour, self.began, self.flushed = None, None, None, 0, 0
        self.segments = 0
        for path in sorted((self.root / "_open").rglob("*.tsv")) if (self.root / "_open").exists() else ():
            self._move(path)

    def write(self, payload: str | bytes, at_ns: int | None = None) -> None:
        ns = self.clock() // 1000 * 1000 if at_ns is None else at_ns
        hour = datetime.fromtimestamp(ns // 1_000_000_000, UTC).strftime("%Y-%m-%d/%H")
        if self.file and (hour != self.hour or ns - self.began > self.seconds * 1e9):
            self.close()
        if not self.file:
            self.path = self.root / "_open" / f"{ns}-{os.getpid()}-{self.segments}" / f"{hour}.tsv"
            self.path.parent.mkdir(parents=True, exist_ok=True)
            self.file, self.hour, self.began, self.flushed = self.path.open("a", encoding="utf-8", newline=""), hour, ns, ns
        self.file.write(f"{ns}\t{payload.decode() if isinstance(payload, bytes) else payload}\n")
        if ns - self.flushed > self.flush_s * 1e9:
            self.file.flush()
            self.flushed = ns

    def _move(self, path: Path) -> None:
        to = self.root / path.relative_to(self.root / "_open")
        to.parent.mkdir(parents=True, exist_ok=True)
        if self.compressed:
            packed = path.with_suffix(".tsv.gz")
            with path.open("rb") as source, gzip.open(packed, "wb") as target:
                shutil.copyfileobj(source, target)
            packed.rename(to.with_suffix(".tsv.gz"))
            path.unlink()
        else:
            path.rename(to)

    def close(self) -> None:
        if self.file:
            self.file.close()
            self._move(self.path)
            self.file, self.segments = None, self.segments + 1


def record(stream: Iterable[str], recorder: Recorder, *, seconds: float | None = None, clock=time.monotonic) -> int:
    """Record frames until the stream or the time ends; says how many."""
    n, until = 0, None if seconds is None else clock() + seconds
    try:
        for payload in stream:
            if until is not None and clock() >= until:
                break
            recorder.write(payload)
            n += 1
    finally:
        recorder.close()
    return n


class Feed:
    """Frames that a thread takes from a stream, by index; it waits while `most` frames haven't been committed."""

    def __init__(self, stream: Iterable[str], most: int = 10_000):
        self.held: deque = deque()
        self.first, self.most, self.ended, self.changed = 0, most, False, threading.Condition()
        self.thread = threading.Thread(target=self._run, args=(stream,), daemon=True)
        self.thread.start()

    def _run(self, stream: Iterable[str]) -> None:
        try:
            for payload in stream:
                with self.changed:
                    self.changed.wait_for(lambda: len(self.held) < self.most)
                    self.held.append((datetime.now(UTC), payload))
        finally:
            self.ended = True

    def pull(self, index: int, most: int) -> list[tuple[int, datetime, str]]:
        with self.changed:
            begin = max(0, index - self.first)
            return [(self.first + i, *self.held[i]) for i in range(begin, min(len(self.held), begin + most))]

    def commit(self, index: int) -> None:
        """Frames before index aren't needed any more."""
        with self.changed:
            while self.held and self.first < index:
                self.held.popleft()
                self.first += 1
            self.changed.notify_all()


_feed: Feed | None = None


def socket_feed() -> Feed:
    """The process's feed of the WebSocket that the environment's settings name, with markers and backoff."""
    global _feed
    if _feed is None:
        from tideline.sources.settings import load

        url = load().url
        _feed = Feed(frames(lambda: WebSocket(url)))
    return _feed


class FrameSource(DataSource):
    """`spark.readStream.format("frames")`; the option feed names an importable function that gives a Feed (default: socket_feed)."""

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return "seq bigint, received_at timestamp, payload string"

    def simpleStreamReader(self, schema):  # noqa: N802
        return _FrameReader(self.options)


class _FrameReader(SimpleDataSourceStreamReader):
    """Holds the feed's name alone, as the reader travels; the feed belongs to the process.

    Frames that weren't committed when that ended can't be read again: where they must be, record them and stream the archive.
    """

    def __init__(self, options):
        self.name, self.most = options.get("feed", "tideline.sources.live:socket_feed"), int(options.get("maxframes", "10000"))

    @property
    def feed(self) -> Feed:
        from importlib import import_module

        module, _, name = self.name.partition(":")
        return getattr(import_module(module), name)()

    def initialOffset(self):  # noqa: N802
        return {"index": 0}

    def read(self, start):
        rows = self.feed.pull(start["index"], self.most)
        return iter(rows), {"index": rows[-1][0] + 1 if rows else start["index"]}

    def readBetweenOffsets(self, start, end):  # noqa: N802
        return iter([r for r in self.feed.pull(start["index"], end["index"] - start["index"]) if r[0] < end["index"]])

    def commit(self, end):
        self.feed.commit(end["index"])
