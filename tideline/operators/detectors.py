"""Anomaly detectors over feature rows. A detector is a function of a DataFrame that adds score and threshold."""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.running import numbered, pieced

NAMES = ("log_trade_count", "log_notional", "spread_bps", "log_abs_return_bps")
#: Of features with equal |z| the first in this order leads.
PRIORITY = ("spread_bps", "log_notional", "log_trade_count", "log_abs_return_bps")


def vectors(features: DataFrame) -> DataFrame:
    """Feature rows that can be scored, with the four scored values x_<name> and seen, their number within the symbol."""
    rows = features.where("spread_bps is not null and abs_return_bps is not null")
    rows = rows.withColumns({"x_log_trade_count": F.log1p(F.col("trade_count").cast("double")), "x_log_notional": F.log1p("notional"), "x_spread_bps": F.col("spread_bps"), "x_log_abs_return_bps": F.log1p("abs_return_bps")})
    return numbered(pieced(rows, "symbol", "time"), ["symbol"], "time", "seen").withColumn("seen", F.col("seen").cast("int")).drop("piece")


def feature_map(*, z: bool = False) -> Column:
    pairs = [v for n in NAMES for v in (F.lit(n), F.col(f"x_{n}"))]
    if z:
        pairs += [v for n in NAMES for v in (F.lit(f"z_{n}"), F.col(f"z_{n}"))]
    return F.create_map(*pairs)


def rolling_medians(values: np.ndarray, window: int) -> np.ndarray:
    """The median of the window values before each place (of fewer at the beginning; nan for the first). One value goes into a sorted list and one out at each step."""
    out, held, flow = np.full(len(values), np.nan), [], values.tolist()
    for i, x in enumerate(flow):
        if held:
            half = len(held) // 2
            out[i] = held[half] if len(held) % 2 else (held[half - 1] + held[half]) / 2
        if i >= window:
            del held[bisect.bisect_left(held, flow[i - window])]
        bisect.insort(held, x)
    return out


#: Rows whose frames are worked out at once: so many times a window's values are held.
FRAMES = 4096


def rolling_moments(values: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population standard deviation of the window values before each place (of fewer at the beginning; nan for the first)."""
    n = len(values)
    mean, std = np.full(n, np.nan), np.full(n, np.nan)
    for i in range(1, min(n, window)):
        mean[i], std[i] = values[:i].mean(), values[:i].std()
    if n > window:
        frames = np.lib.stride_tricks.sliding_window_view(values[:-1], window)
        for at in range(0, len(frames), FRAMES):
            some = frames[at : at + FRAMES]
            mean[window + at : window + at + len(some)], std[window + at : window + at + len(some)] = some.mean(axis=1), some.std(axis=1)
    return mean, std


def zscores(rows: DataFrame, *, window: int = 300, min_samples: int = 60, threshold: float = 4.0, chunk: int = 50_000) -> DataFrame:
    """vectors() with z_<name>, score (the largest |z|) and threshold; score is null until min_samples rows came before.

    The frame is the window rows before the row. A standard deviation within float noise of zero counts as zero, and that
    of the spread is at least half the frame's median spread. A symbol's rows are cut into chunks that carry the window
    rows before them, so a symbol isn't one task, and no chunk holds more than chunk + window rows.
    """
    at = F.floor((F.col("seen") - 1) / chunk)
    reach = -(-window // chunk)
    last = F.floor((F.col("seen") - 1 + window) / chunk)
    cut = rows.withColumn("__own", at).withColumn("__cut", F.explode(F.sequence(at, F.least(last, at + reach))))
    names = rows.columns
    scores = [*(f"z_{n}" for n in NAMES), "score"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), *(f"{c} double" for c in scores)])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("seen")
        own = (group["__own"].to_numpy() == group["__cut"].to_numpy()) if len(group) else np.zeros(0, bool)
        before = np.minimum(np.arange(len(group)), window)
        out, most = {}, np.zeros(len(group))
        for n in NAMES:
            x = group[f"x_{n}"].to_numpy()
            mean, std = rolling_moments(x, window)
            std = np.where(std <= 1e-9 * np.maximum(1.0, np.abs(mean)), 0.0, std)
            if n == "spread_bps":
                std = np.maximum(std, 0.5 * rolling_medians(x, window))
            out[n] = np.divide(x - mean, std, out=np.zeros(len(x)), where=std > 0)
            most = np.maximum(most, np.abs(out[n]))
        early = (before < max(min_samples, 1))[own]
        kept = group.filter(pa.array(own)).select(names)
        for name, z in zip(scores, [*out.values(), most], strict=True):
            kept = kept.append_column(name, pa.array(z[own], pa.float64(), mask=early))
        return kept

    return cut.groupBy("symbol", "__cut").applyInArrow(run, schema).withColumn("threshold", F.lit(float(threshold)))


def zscore_of(before: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The z of one row's values, given the rows of its frame; as zscores() works them out."""
    mean, std = before.mean(axis=0), before.std(axis=0)
    std = np.where(std <= 1e-9 * np.maximum(1.0, np.abs(mean)), 0.0, std)
    at = NAMES.index("spread_bps")
    std[at] = max(std[at], 0.5 * np.median(before[:, at]))
    return np.divide(x - mean, std, out=np.zeros(len(x)), where=std > 0)


def flags(scored: DataFrame, detector: str, *, z: bool = False) -> DataFrame:
    return scored.where("score > threshold").select("time", "symbol", F.lit(detector).alias("detector"), "score", "threshold", feature_map(z=z).alias("features"))


def driver(prefix: str = "z_") -> Column:
    """The name of the feature with the largest |z|."""
    entries = F.array(*(F.struct(F.abs(f"{prefix}{n}").alias("v"), F.lit(-i).alias("p"), F.lit(n).alias("n")) for i, n in enumerate(PRIORITY)))
    return F.array_max(entries)["n"]


# ---------------------------------------------------------------- isolation forest


def path_norm(n: np.ndarray | float) -> np.ndarray:
    """The mean depth of an unsuccessful search in a binary tree of n."""
    n = np.asarray(n, np.float64)
    safe = np.maximum(n, 2.0)
    return np.where(n > 2, 2 * (np.log(safe - 1) + 0.5772156649015329) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """All trees of a forest, grown level by level at once.

    A tree is a heap: the children of node i are 2 i + 1 and 2 i + 2. feature is -1 at leaves, cut the threshold and depth
    what a leaf stands for. A node that has more than one distinct row below the height limit is split at a uniform point of
    a feature that isn't constant in it, all such features being equally likely.
    """

    def __init__(self, data: np.ndarray, *, trees: int = 100, subsample: int = 256, seed: int = 0):
        draw = np.random.default_rng(seed)
        self.psi = min(subsample, len(data))
        self.limit = int(np.ceil(np.log2(max(self.psi, 2))))
        size = (2 << self.limit) - 1
        self.feature, self.cut, self.depth = np.full(trees * size, -1), np.zeros(trees * size), np.zeros(trees * size)
        self.root = np.arange(trees) * size
        picked = np.argsort(draw.random((trees, len(data))), axis=1)[:, : self.psi]
        rows, node = data[picked.reshape(-1)], np.repeat(self.root, self.psi)
        place = np.zeros(len(rows), np.int64)  # within its tree's heap
        for level in range(self.limit + 1):
            order = np.argsort(node, kind="stable")
            rows, node, place = rows[order], node[order], place[order]
            begin = np.flatnonzero(np.diff(node, prepend=-1))
            if not len(begin):
                break
            count = np.diff(begin, append=len(node))
            low, high = np.minimum.reduceat(rows, begin), np.maximum.reduceat(rows, begin)
            can = high > low
            split = can.any(axis=1) & (level < self.limit)
            at = node[begin]
            self.depth[at[~split]] = level + path_norm(count[~split])
            if not split.any():
                break
            nth = np.floor(draw.random(len(begin)) * can.sum(axis=1)) + 1
            f = (can.cumsum(axis=1) >= nth[:, None]).argmax(axis=1)
            own = np.arange(len(begin))
            cut = low[own, f] + draw.random(len(begin)) * (high[own, f] - low[own, f])
            self.feature[at[split]], self.cut[at[split]] = f[split], cut[split]
            group = np.repeat(own, count)
            kept = split[group]
            rows, node, place, group = rows[kept], node[kept], place[kept], group[kept]
            right = rows[np.arange(len(rows)), f[group]] >= cut[group]
            child = 2 * place + 1 + right
            node, place = node - place + child, child

    def score(self, x: np.ndarray) -> np.ndarray:
        """From near 0 (ordinary) to 1 (isolated at once)."""
        total, n = np.zeros(len(x)), np.arange(len(x))[:, None]
        place, at = np.zeros((len(x), len(self.root)), np.int64), np.broadcast_to(self.root, (len(x), len(self.root)))
        for _ in range(self.limit):
            f = self.feature[at + place]
            right = x[n, np.maximum(f, 0)] >= self.cut[at + place]
            place = np.where(f >= 0, 2 * place + 1 + right, place)
        total = self.depth[at + place].sum(axis=1)
        return 2.0 ** (-total / max(1, len(self.root)) / max(float(path_norm(self.psi)), 1e-12))


def fit_id(train_window: int = 3600, refit_every: int = 600, swap_after: int = 30) -> Column:
    """The number of the fit that scores the row with this seen (null: none yet)."""
    swap = max(swap_after, 1)
    step = max(refit_every, swap)
    n = F.floor((F.col("seen") - train_window - swap) / step)
    return F.when(F.col("seen") >= train_window + swap, n)


def forest_scores(rows: DataFrame, *, train_window: int = 3600, refit_every: int = 600, swap_after: int = 30, quantile: float = 0.999, trees: int = 100, seed: int = 0) -> DataFrame:
    """symbol, time, seen, fit_id, score and threshold of every row that a fit scores.

    Fit j learns from the train_window rows up to train_window + j * step and scores step rows from swap_after later, so
    each fit is a task of its own of bounded size: its rows are copied to it, and symbols don't limit how many run.
    """
    swap = max(swap_after, 1)
    step = max(refit_every, swap)
    seen = F.col("seen")
    own = F.floor((seen - train_window - swap) / step)
    first = F.greatest(F.lit(0), F.ceil((seen - train_window) / step))
    last = F.floor((seen - 1) / step)  # fits with f - T < seen <= f, f = T + j * step
    trains = F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>"))
    base = rows.select("symbol", "time", "seen", *(f"x_{n}" for n in NAMES))
    learn = base.withColumn("fit_id", F.explode(trains)).withColumn("role", F.lit("train"))
    judge = base.where(seen >= train_window + swap).withColumn("fit_id", own.cast("int")).withColumn("role", F.lit("score"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seen", kind="stable")
        x = pdf[[f"x_{n}" for n in NAMES]].to_numpy(np.float64)
        learned = (pdf["role"] == "train").to_numpy()
        out = pdf.loc[~learned, ["symbol", "time", "seen", "fit_id"]].copy()
        if not len(out) or not learned.any():
            return out.assign(score=pd.Series(dtype="float64"), threshold=pd.Series(dtype="float64"))
        forest = IsolationForest(x[learned], trees=trees, seed=seed)
        return out.assign(score=forest.score(x[~learned]), threshold=float(np.quantile(forest.score(x[learned]), quantile)))

    return learn.unionByName(judge).groupBy("symbol", "fit_id").applyInPandas(run, "symbol string, time timestamp, seen int, fit_id int, score double, threshold double")
