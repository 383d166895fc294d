"""Replay: everything that the pipeline makes of raw frames, as DataFrames, and its summary and sink."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import decode
from tideline.functions.running import pieced
from tideline.operators import detectors, features, gaps
from tideline.schemas import DAILY, conformed
from tideline.sources import sinks
from tideline.sources.shared import settled, settled_count

STATUSES = ("trade", "depth", "quote", "other", "error", "marker", "comment")


@dataclass(frozen=True)
class Settings:
    """The defaults are those of production; tests and sparse data take wider buckets and shorter windows."""

    width_us: int = features.SECOND_US
    max_fill: int = features.MAX_FILL
    window: int = 300
    min_samples: int = 60
    threshold: float = 4.0
    train_window: int = 3600
    refit_every: int = 600
    swap_after: int = 30
    quantile: float = 0.999
    trees: int = 100


class Replay:
    """The results over raw frames (seq, received_at, payload). Each is made when it is first asked for.

    Frames are decoded once: the typed records, cut along seq into pieces of bounded size, and the feature rows are tables
    in the shared folder that all that comes after reads.
    """

    def __init__(self, raw: DataFrame, settings: Settings = Settings()):  # noqa: B008
        self.raw, self.settings = raw, settings

    @cached_property
    def frames(self) -> DataFrame:
        return decode.decoded(self.raw)

    @cached_property
    def records(self) -> DataFrame:
        rows, count = settled_count(decode.typed(self.frames), "records")
        return pieced(rows, "seq", count=count)

    @property
    def trades(self) -> DataFrame:
        return decode.trades(self.records)

    @property
    def depth(self) -> DataFrame:
        return decode.depth(self.records)

    @property
    def quotes(self) -> DataFrame:
        return decode.quotes(self.records)

    @cached_property
    def gaps(self) -> DataFrame:
        return gaps.detect_gaps(self.depth, decode.markers(self.records))

    @cached_property
    def features(self) -> DataFrame:
        return settled(features.build_features(self.trades, self.quotes, width_us=self.settings.width_us, max_fill=self.settings.max_fill), "features")

    def features_of(self, symbol: str) -> DataFrame:
        """The features of one symbol: the clock is that of all, but only its own rows are bucketed."""
        s = self.settings
        return features.build_features(self.trades, self.quotes, width_us=s.width_us, max_fill=s.max_fill, symbol=symbol)

    def vectors(self) -> DataFrame:
        return detectors.vectors(self.features)

    def zscores(self) -> DataFrame:
        s = self.settings
        return detectors.zscores(self.vectors(), window=s.window, min_samples=s.min_samples, threshold=s.threshold)

    def forest(self) -> DataFrame:
        s = self.settings
        return detectors.forest_scores(self.vectors(), train_window=s.train_window, refit_every=s.refit_every, swap_after=s.swap_after, quantile=s.quantile, trees=s.trees)

    def flags(self) -> DataFrame:
        z = detectors.flags(self.zscores(), "zscore", z=True)
        f = self.forest().join(self.vectors().drop("seen"), ["symbol", "time"])
        return z.unionByName(detectors.flags(f, "iforest"))

    def counts(self) -> DataFrame:
        """Frames by status, as one row."""
        return self.frames.agg(F.count("*").alias("frames"), *(F.count_if(F.col("status") == k).alias(f"n_{k}") for k in STATUSES))

    def summary(self, *, forest: bool = True) -> DataFrame:
        """One row: frames by status, rows that the sinks take, feature rows, gaps by cause and flags by detector."""
        frames = self.counts().withColumn("n_rows", F.col("n_trade") + F.col("n_depth")).withColumnRenamed("n_error", "parse_errors")
        found = self.gaps.agg(F.count("*").alias("gaps"), F.count_if(F.col("cause") == "reconnect").alias("reconnect_gaps"))
        flags = self.flags() if forest else detectors.flags(self.zscores(), "zscore", z=True)
        flagged = flags.agg(F.count("*").alias("flags"), *(F.count_if(F.col("detector") == d).alias(f"{d}_flags") for d in ("zscore", "iforest")))
        one = lambda df: df.withColumn("__one", F.lit(1))
        built = self.features.agg(F.count("*").alias("feature_rows"))
        return one(frames).join(one(built), "__one").join(one(found), "__one").join(one(flagged), "__one").drop("__one")

    def store(self, root: str) -> dict[str, int]:
        """Merge all tables into root, and say how many rows each took; a second replay of the same frames changes nothing."""
        tables = {"trades": self.trades, "depth_updates": self.depth, "depth_gaps": self.gaps, "features": self.features, "anomaly_flags": self.flags()}
        return {name: sinks.merge(conformed(df, name), f"{root}/{name}", name, partition="time" if name in DAILY else None) for name, df in tables.items()}

    def run(self, root: str | None = None) -> dict:
        """Replay all, into root if there is one: the summary with seconds, frames a second, rows written and flushes (one a table)."""
        began = time.perf_counter()
        took = self.store(root) if root else {}
        row = self.summary().first().asDict()
        seconds = time.perf_counter() - began
        return row | {"rows_written": sum(took.values()), "flushes": sum(n > 0 for n in took.values()), "seconds": round(seconds, 3), "frames_per_s": round(row["frames"] / seconds, 1)}
