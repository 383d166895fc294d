"""Exact order statistics and quantiles of groups of any size, without a sort or a buffer of all values.

One pass makes a quantile sketch (KLL) of each group. It says between which two values a wanted rank lies, give or take its
error. A second pass counts, exactly, the values below and those between, equal ones as one row; only these few are ordered,
in range partitions. Where the count shows that the rank wasn't between (the sketch erred by more than expected), that one is
looked for again between wider bounds, in the end between the least and the greatest value, so the result is always exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.running import pieced, summed_before
from tideline.sources.shared import settled, small

#: Entries of a sketch (an error of about 0.1 percent of ranks, a few ten kilobytes) and steps at which it is asked.
SKETCH, STEPS = 2048, 256


def order_statistics(df: DataFrame, by: list[str], value: str, ranks: Callable[[Column], Column], *, reach: int = 1) -> DataFrame:
    """by, n, name, rank and value: of each group, the values at the ranks that ranks(n) gives as an array of (name, rank).

    Ranks begin with 0, the least value; n is the number of values that aren't null. Groups without values have no rows.
    reach is how many steps around its own a rank is looked for in at first.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v"))
    keys = by or ["__all"]
    if not by:
        rows = rows.withColumn("__all", F.lit(0))
    grid = F.array(*(F.lit(i / STEPS) for i in range(STEPS + 1)))
    sketch = rows.groupBy(*keys).agg(F.kll_sketch_agg_double("v", F.lit(SKETCH)).alias("k"), F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    known = sketch.select(*keys, "n", "least", "most", F.kll_sketch_get_quantile_double("k", grid).alias("edges"), F.inline(ranks(F.col("n")).cast("array<struct<name:string,rank:bigint>>")))
    wanted = settled(known.where("rank >= 0 and rank < n"), "selection-wanted")
    found = None
    while True:
        at = F.floor(F.col("rank") * STEPS / F.col("n"))
        low = F.when(at < reach, F.col("least")).otherwise(F.get("edges", (at - reach).cast("int")))
        high = F.when(at + reach + 1 > STEPS, F.col("most")).otherwise(F.get("edges", (at + reach + 1).cast("int")))
        bounds = wanted.select(*keys, "name", low.alias("low"), high.alias("high"))
        # values below are one row without a value
        met = rows.join(small(bounds), keys).where("v <= high").groupBy(*keys, "name", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v")).agg(F.count("*").alias("w"))
        met = settled(met, "selection-met")
        sums = met.groupBy(*keys, "name").agg(F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("w"))), F.lit(0)).alias("below"), F.sum("w").alias("upto"))
        judged = settled(wanted.join(sums, [*keys, "name"], "left").withColumn("hit", F.coalesce((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("upto")), F.lit(False))), "selection-judged")
        inside = met.where("v is not null").join(small(judged.where("hit").select(*keys, "name", "n", "rank", "below")), [*keys, "name"])
        along = summed_before(pieced(inside, *keys, "name", "v"), [*keys, "name"], "v", "w", "before")
        here = along.where("below + before <= rank and rank < below + before + w").select(*by, "n", "name", "rank", F.col("v").alias("value"))
        found = here if found is None else found.unionByName(here)
        wanted = judged.where("not hit").select(*keys, "n", "least", "most", "edges", "name", "rank")
        if reach > STEPS or wanted.isEmpty():
            return found
        reach *= 16


def quantiles(df: DataFrame, by: list[str], value: str, at: list[float]) -> DataFrame:
    """by, n and q0, q1, ..: the quantiles at these shares, by linear interpolation between the two values around each."""
    place = lambda q, n: F.lit(float(q)) * (n - 1)
    low = lambda q, n: F.floor(place(q, n)).cast("bigint")
    ranks = lambda n: F.array(*(F.struct(F.lit(f"{i}{s}").alias("name"), F.least(low(q, n) + d, n - 1).alias("rank")) for i, q in enumerate(at) for s, d in (("a", 0), ("b", 1))))
    rows = order_statistics(df, by, value, ranks)
    wide = rows.groupBy(*by, "n").agg(*(F.max(F.when(F.col("name") == f"{i}{s}", F.col("value"))).alias(f"{s}{i}") for i in range(len(at)) for s in "ab"))
    mixed = lambda i, q: F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * (place(q, F.col("n")) - low(q, F.col("n")))
    return wide.select(*by, "n", *(mixed(i, q).alias(f"q{i}") for i, q in enumerate(at)))


def top_bounds(df: DataFrame, by: list[str], value: str, rates: tuple[float, ...]) -> DataFrame:
    """by, n, name and value: for each rate, by its place in rates, the least value of a group's top max(1, ceil(rate * n))."""
    k = lambda r, n: F.greatest(F.lit(1), F.ceil(F.lit(r) * n))
    return order_statistics(df, by, value, lambda n: F.array(*(F.struct(F.lit(str(i)).alias("name"), (n - k(r, n)).cast("bigint").alias("rank")) for i, r in enumerate(rates))))
