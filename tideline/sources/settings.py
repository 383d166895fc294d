"""Settings of the live side, from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

KINDS = ("trade", "depth@{depth_ms}ms", "bookTicker")


@dataclass(frozen=True)
class LiveSettings:
    base: str = "wss://stream.binance.com:9443"
    symbols: tuple[str, ...] = ("btcusdt", "ethusdt")
    depth_ms: int = 100
    archive: str = "data/raw"
    store: str = "data/store"

    @property
    def streams(self) -> list[str]:
        """The streams of each symbol, joined in one connection."""
        return [f"{s}@{k.format(depth_ms=self.depth_ms)}" for s in self.symbols for k in KINDS]

    @property
    def url(self) -> str:
        return f"{self.base}/stream?streams={'/'.join(self.streams)}"


def symbols_of(text: str) -> tuple[str, ...]:
    """The symbols of a comma-separated list, in lower case and without blanks."""
    return tuple(s.strip().lower() for s in text.split(",") if s.strip())


def load(environment: Mapping[str, str] | None = None) -> LiveSettings:
    """Settings with the variables WS_BASE, SYMBOLS, DEPTH_INTERVAL_MS, RAW_DIR and STORE_DIR; what is unset keeps its default."""
    env, default = os.environ if environment is None else environment, LiveSettings()
    symbols = symbols_of(env["SYMBOLS"]) if "SYMBOLS" in env else default.symbols
    if not symbols:
        raise ValueError("SYMBOLS must name at least one symbol")
    return LiveSettings(env.get("WS_BASE", default.base), symbols, int(env.get("DEPTH_INTERVAL_MS", default.depth_ms)), env.get("RAW_DIR", default.archive), env.get("STORE_DIR", default.store))
