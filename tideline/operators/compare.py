"""Comparing two detectors' scores over the rows that both score.

The functions take rows with symbol, time, a_score, a_flag, b_score and b_flag, and the four x_<name> columns where
feature percentiles are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.running import numbered, pieced, summed_before
from tideline.operators.detectors import NAMES
from tideline.operators.selection import top_bounds
from tideline.sources.shared import settled, small

RATES = (0.001, 0.01)
NEAR_S = 2


def both_scored(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that both detectors score."""
    left = a.where("score is not null").select("symbol", "time", *[c for c in a.columns if c.startswith("x_")], F.col("score").alias("a_score"), (F.col("score") > F.col("threshold")).alias("a_flag"))
    right = b.where("score is not null").select("symbol", "time", F.col("score").alias("b_score"), (F.col("score") > F.col("threshold")).alias("b_flag"))
    return left.join(right, ["symbol", "time"])


def flag_overlap(scored: DataFrame) -> DataFrame:
    """Counts of the flag sets, of their overlap, and the Jaccard coefficient (null if no flags)."""
    n = lambda c: F.count_if(c)
    a, b = F.col("a_flag"), F.col("b_flag")
    return scored.groupBy("symbol").agg(n(a).alias("n_a"), n(b).alias("n_b"), n(a & b).alias("n_both"), n(a & ~b).alias("a_only"), n(b & ~a).alias("b_only"), F.try_divide(n(a & b), n(a | b)).alias("jaccard"))


def alarm_rates(scored: DataFrame, per_hour: int = 3600) -> DataFrame:
    """Flags, flags an hour (of per_hour rows) and share of rows, by detector."""
    n = F.count("*")
    return scored.groupBy("symbol").agg(n.alias("n_rows"), *(x for d in "ab" for x in (F.count_if(f"{d}_flag").alias(f"{d}_flags"), (F.count_if(f"{d}_flag") * per_hour / n).alias(f"{d}_per_hour"), (F.count_if(f"{d}_flag") / n).alias(f"{d}_share"))))


def near_flags(scored: DataFrame, reach_s: int = NEAR_S) -> DataFrame:
    """Rows that only a flags, with a flag of b within reach_s: a band semi-join, by cells of reach_s."""
    us = F.unix_micros("time")
    cell = F.floor(us / (reach_s * 1_000_000))
    left = scored.where("a_flag and not b_flag").withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    right = scored.where("b_flag").select(F.col("symbol").alias("s"), F.col("time").alias("t"), cell.alias("c"))
    close = F.abs(F.unix_micros("time") - F.unix_micros("t")) <= reach_s * 1_000_000
    return left.join(right, (F.col("symbol") == F.col("s")) & (F.col("cell") == F.col("c")) & close, "left_semi").drop("cell").dropDuplicates(["symbol", "time"])


def ranked(scored: DataFrame, rate: float) -> DataFrame:
    """The rows that may be in the top of a or of b at rate, with n_rows (of the symbol) and a_place and b_place.

    The least score of each top is selected first; only rows that reach it are ordered. A place is the one in the symbol by
    score, earlier of equals first, for rows that reach the top's least score, and a greater one for others.
    """
    bounds = {d: top_bounds(scored, ["symbol"], f"{d}_score", (rate,)).select("symbol", F.col("n").alias("n_rows"), F.col("value").alias(f"{d}_least")) for d in "ab"}
    least = settled(bounds["a"].join(bounds["b"].drop("n_rows"), "symbol"), "least")
    out = settled(scored.join(small(least), "symbol").where("a_score >= a_least or b_score >= b_least").drop("a_least", "b_least"), "tops")
    for d in "ab":
        out = out.withColumn("__o", F.struct(-F.col(f"{d}_score"), F.col("time")))
        out = numbered(pieced(out, "symbol", "__o"), ["symbol"], "__o", f"{d}_place").drop("__o", "piece")
    return out


def _tops(rate: float) -> tuple[Column, Column, Column]:
    """k = max(1, ceil(rate * n)), and whether a row is in the top k of a and of b, for ranked() rows."""
    k = F.greatest(F.lit(1), F.ceil(F.lit(rate) * F.col("n_rows")))
    return k, F.col("a_place") <= k, F.col("b_place") <= k


def topk_overlap(scored: DataFrame, rates: tuple[float, ...] = RATES) -> DataFrame:
    """For each rate, how many of the top k rows of a and b are the same; the tops are ranked once for all rates."""
    each = []
    for rate in rates:
        k, a, b = _tops(rate)
        each.append(F.struct(F.lit(rate).alias("rate"), k.alias("k"), (a & b).alias("both")))
    rows = ranked(scored, max(rates)).select("symbol", "n_rows", F.inline(F.array(*each)))
    out = rows.groupBy("symbol", "rate").agg(F.max("k").alias("k"), F.max("n_rows").alias("n_rows"), F.count_if("both").alias("n_common"))
    return out.withColumn("overlap", F.col("n_common") / F.col("k")).withColumn("by_chance", F.col("k") / F.col("n_rows"))


def ranks(rows: DataFrame, column: str) -> DataFrame:
    """symbol, column, n and below for each distinct value: how many rows have it, and how many a smaller one.

    Values are counted before they are ordered, so that equal ones are one row.
    """
    counts = settled(rows.groupBy("symbol", column).agg(F.count("*").alias("n")), "ranks")
    return summed_before(pieced(counts, "symbol", column), ["symbol"], column, "n", "below").drop("piece")


def spearman(scored: DataFrame) -> DataFrame:
    """The correlation of the ranks, equal values sharing the mean of theirs; null where a rank is constant."""
    pairs = scored.groupBy("symbol", "a_score", "b_score").agg(F.count("*").alias("w"))
    for d in "ab":
        own = ranks(scored, f"{d}_score").select("symbol", f"{d}_score", (F.col("below") + (F.col("n") + 1) / 2).alias(f"r{d}"))
        pairs = pairs.join(own, ["symbol", f"{d}_score"])
    n = scored.groupBy("symbol").agg(F.count("*").alias("n_rows"))
    middle, w = (F.col("n_rows") + 1) / 2, F.col("w")
    rows = pairs.join(small(n), "symbol").withColumns({"u": F.col("ra") - middle, "v": F.col("rb") - middle})
    sums = rows.groupBy("symbol").agg(F.max("n_rows").alias("n_rows"), *(F.sum(w * x * y).alias(k) for k, x, y in (("uv", F.col("u"), F.col("v")), ("uu", F.col("u"), F.col("u")), ("vv", F.col("v"), F.col("v")))))
    return sums.select("symbol", F.try_divide("uv", F.sqrt(F.col("uu") * F.col("vv"))).alias("rho"), "n_rows")


def _picked(scored: DataFrame, rate: float) -> DataFrame:
    """The rows in the top of a, of b or of both."""
    _, a, b = _tops(rate)
    return ranked(scored, rate).withColumn("picked", F.when(a & b, "both").when(a, "a_only").when(b, "b_only")).where("picked is not null")


def percentile_ranks(scored: DataFrame, rate: float = 0.01) -> DataFrame:
    """By who picks a row into its top: the median of each feature's share of smaller rows, in percent. Only picked rows are joined with ranks."""
    rows = _picked(scored, rate)
    for n in NAMES:
        rows = rows.join(ranks(scored, f"x_{n}").select("symbol", f"x_{n}", F.col("below").alias(f"r_{n}")), ["symbol", f"x_{n}"])
    return rows.groupBy("symbol", "picked").agg(F.count("*").alias("n_rows"), *(F.percentile(F.col(f"r_{n}") / F.col("n_rows") * 100, 0.5).alias(f"p_{n}") for n in NAMES))


def top_examples(scored: DataFrame, rate: float = 0.01, n: int = 5) -> DataFrame:
    """The n strongest of a's own top rows, of b's own, and of those that both pick (by b_score)."""
    by = F.when(F.col("picked") == "a_only", F.col("a_place")).otherwise(F.col("b_place"))
    place = F.row_number().over(Window.partitionBy("symbol", "picked").orderBy(by))  # of a hundredth of the rows; Spark keeps n of a group in each task
    return _picked(scored, rate).withColumn("place", place).where(F.col("place") <= n).select("symbol", "picked", "place", "time", "a_score", "b_score")


def reproduced(flags: DataFrame, stored: DataFrame) -> DataFrame:
    """A row: how many flags are on one side only; the two agree if both are 0."""
    a, b = flags.select("symbol", "time"), stored.select("symbol", "time")
    sides = a.groupBy("symbol", "time").agg(F.count("*").alias("n")).withColumn("new", F.lit(True)).unionByName(b.groupBy("symbol", "time").agg(F.count("*").alias("n")).withColumn("new", F.lit(False)))
    net = sides.groupBy("symbol", "time").agg(F.sum(F.when(F.col("new"), F.col("n")).otherwise(-F.col("n"))).alias("net"))
    none = F.lit(0).cast("bigint")
    return net.agg(F.coalesce(F.sum(F.greatest("net", none)), none).alias("n_new"), F.coalesce(F.sum(F.greatest(-F.col("net"), none)), none).alias("n_lost"))


def report(scored: DataFrame, title: str = "Detector comparison") -> str:
    """The comparison as Markdown; every table has a few rows per symbol."""

    def lines(name: str, df: DataFrame) -> list[str]:
        rows = df.orderBy(*[c for c in ("symbol", "rate", "picked", "place") if c in df.columns]).collect()
        show = lambda v: "n/a" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v)
        return [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(map(show, r)) + " |" for r in rows), ""]

    parts = [("Alarm rates", alarm_rates(scored)), ("Flags", flag_overlap(scored)), ("Top scores", topk_overlap(scored)), ("Rank correlation", spearman(scored)), ("Feature percentiles", percentile_ranks(scored)), ("Examples", top_examples(scored))]
    return "\n".join([f"# {title}", "", *(x for name, df in parts for x in lines(name, df))])
