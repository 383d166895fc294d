"""Operations on metric series: (ts in seconds, series columns, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.running import neighbour, pieced, summed_before
from tideline.operators.selection import quantiles


#: How many windows' length a cell of a series has.
CELL_WINDOWS = 16


def _steps(samples: DataFrame, series: list[str], ts: str, value: str) -> DataFrame:
    """Adds __step, the rise of a counter since its sample before (0 for the first); a fall is a restart from zero.

    Samples are cut along time into pieces of bounded size, so a long series isn't one task.
    """
    near = neighbour(pieced(samples, ts), series, ts, F.col(value), "__before").drop("piece")
    before = F.col("__before")
    return near.withColumn("__step", F.when(before.isNull(), 0).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)).drop("__before")


def _over_time(samples: DataFrame, series: list[str], seconds: int, ts: str, name: str, total) -> DataFrame:
    """Adds name, total() over the seconds up to each sample: windows within cells of time, into which the samples before are copied that reach into them."""
    cell = F.floor(F.col(ts) / (seconds * CELL_WINDOWS))
    reach = F.floor((F.col(ts) + (seconds - 1)) / (seconds * CELL_WINDOWS))
    cut = samples.withColumn("__own", cell).withColumn("__cell", F.explode(F.sequence(cell, reach)))
    w = Window.partitionBy(*series, "__cell").orderBy(ts).rangeBetween(-seconds + 1, 0)
    return cut.withColumn(name, total.over(w)).where("__cell = __own").drop("__own", "__cell")


def increase(samples: DataFrame, series: list[str], seconds: int, ts: str = "ts", value: str = "value", name: str = "increase") -> DataFrame:
    """How much a counter rose in the seconds up to each sample; a fall is a restart from zero. Not extrapolated to the window's ends."""
    return _over_time(_steps(samples, series, ts, value), series, seconds, ts, name, F.sum("__step")).drop("__step")


def rate(samples: DataFrame, series: list[str], seconds: int, ts: str = "ts", value: str = "value") -> DataFrame:
    return increase(samples, series, seconds, ts, value, "rate").withColumn("rate", F.col("rate") / seconds)


def increase_at(samples: DataFrame, series: list[str], at: list[int], seconds: int, ts: str = "ts", value: str = "value") -> DataFrame:
    """series, at and increase: how much each counter rose in the seconds up to each of these times, for series with samples in them."""
    times = F.filter(F.array(*map(F.lit, at)), lambda t: (t >= F.col(ts)) & (t - seconds < F.col(ts)))
    return _steps(samples, series, ts, value).withColumn("at", F.explode(times)).groupBy(*series, "at").agg(F.sum("__step").alias("increase"))


def extrapolated_at(samples: DataFrame, series: list[str], seconds: int, every: int, ts: str = "ts", value: str = "value") -> DataFrame:
    """series, at, increase and rate: what each counter rose by in the seconds up to each multiple of every, extrapolated to the window's ends.

    Of the samples in the window (the begin doesn't belong to it) at least two are needed. The rise between the first and the
    last of them is stretched to the ends of the window; to an end that is further away than 1.1 mean distances of samples,
    by half a mean distance only, and not back beyond the moment at which the counter would have been zero. Each window is
    an aggregation over the samples in it, with partial sums, so the length of a series doesn't matter.
    """
    first, last = F.ceil(F.col(ts) / every), F.ceil((F.col(ts) + seconds) / every) - 1
    rows = _steps(samples, series, ts, value).where(first <= last).withColumn("at", F.explode(F.transform(F.sequence(first, last), lambda i: i * every)))
    got = rows.groupBy(*series, "at").agg(
        F.count("*").alias("n"), F.min(ts).alias("t0"), F.max(ts).alias("t1"), F.min_by(value, ts).cast("double").alias("v0"), (F.sum("__step") - F.min_by("__step", ts)).cast("double").alias("rise")
    ).where("n >= 2 and t1 > t0")
    long, mean = F.col("t1") - F.col("t0"), (F.col("t1") - F.col("t0")) / (F.col("n") - 1)
    to_begin, to_end = F.col("t0") - (F.col("at") - seconds), F.col("at") - F.col("t1")
    to_begin, to_end = (F.when(d >= mean * 1.1, mean / 2).otherwise(d.cast("double")) for d in (to_begin, to_end))
    to_zero = F.when((F.col("rise") > 0) & (F.col("v0") >= 0), long * F.col("v0") / F.col("rise"))
    whole = F.col("rise") * (long + F.least(to_begin, to_zero) + to_end) / long
    return got.select(*series, "at", whole.alias("increase"), (whole / seconds).alias("rate"))


def quantile_of_rates(buckets: DataFrame, q: float, by: list[str], series: list[str], at: list[int], seconds: int) -> DataFrame:
    """histogram_quantile(q, sum by (le, by) (rate(buckets[seconds]))) at each of these times.

    buckets are samples (ts, value) of cumulative counters with the bound le; series are the columns besides le that tell
    their series apart (by is among them). Times at which nothing was observed have no quantile.
    """
    rates = increase_at(buckets, [*series, "le"], at, seconds).groupBy(*by, "at", "le").agg((F.sum("increase") / seconds).alias("n"))
    return histogram_quantile(rates, q, [*by, "at"])


def max_over_time(samples: DataFrame, series: list[str], seconds: int, ts: str = "ts", value: str = "value") -> DataFrame:
    return _over_time(samples, series, seconds, ts, "max_over_time", F.max(value))


#: Counters, gauges and histograms that the engine keeps of itself, with their labels; fixed values.
COUNTERS = {"frames_total": ("stream",), "parse_errors_total": (), "rows_submitted_total": (), "disconnects_total": (), "reconnect_attempts_total": (), "depth_gaps_total": ("symbol", "cause"), "anomaly_flags_total": ("symbol", "detector")}
GAUGES = ("queue_depth", "connected", "last_frame_timestamp_seconds")
HISTOGRAMS = {
    "flush_seconds": ((), (0.001, 0.0025, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)),
    "detector_seconds": (("detector",), (0.000025, 0.00005, 0.0001, 0.00025, 0.0005, 0.001, 0.0025, 0.005, 0.01, 0.025, 0.1)),
}


def stream_of(status: Column) -> Column:
    """The name of the stream that frames of a status are counted by."""
    return F.when(status.isin("trade", "depth"), status).when(status == "quote", "bookticker").otherwise("other")


def of_replay(frames: DataFrame, gaps: DataFrame, flags: DataFrame) -> DataFrame:
    """name, labels and value of the counters and gauges that a replay's frames, gaps and flags amount to."""
    stream = stream_of(F.col("status"))
    own = frames.where("status not in ('marker', 'comment')")
    none = F.create_map().cast("map<string,string>")
    row = lambda name, labels, value: (F.lit(name).alias("name"), labels.alias("labels"), value.cast("double").alias("value"))
    parts = [
        own.groupBy(stream.alias("s")).agg(F.count("*").alias("n")).select(*row("frames_total", F.create_map(F.lit("stream"), F.col("s")), F.col("n"))),
        own.agg(F.count_if(F.col("status") == "error").alias("n")).select(*row("parse_errors_total", none, F.col("n"))),
        own.agg(F.count_if(F.col("status").isin("trade", "depth")).alias("n")).select(*row("rows_submitted_total", none, F.col("n"))),
        own.agg((F.unix_micros(F.max("received_at")) / 1e6).alias("n")).select(*row("last_frame_timestamp_seconds", none, F.col("n"))),
        gaps.groupBy("symbol", "cause").agg(F.count("*").alias("n")).select(*row("depth_gaps_total", F.create_map(F.lit("symbol"), F.col("symbol"), F.lit("cause"), F.col("cause")), F.col("n"))),
        flags.groupBy("symbol", "detector").agg(F.count("*").alias("n")).select(*row("anomaly_flags_total", F.create_map(F.lit("symbol"), F.col("symbol"), F.lit("detector"), F.col("detector")), F.col("n"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def summed(samples: DataFrame, by: list[str], value: str) -> DataFrame:
    return samples.groupBy(*by).agg(F.sum(value).alias(value))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def product(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str, name: str) -> DataFrame:
    """One-to-one product of two series; without a partner the product counts as zero."""
    return left.join(right, on, "left").withColumn(name, or_zero(F.col(a) * F.col(b)))


def histogram(values: DataFrame, bounds: list[float], by: list[str], value: str = "value") -> DataFrame:
    """Cumulative counts n of the values up to each bound le, the last being infinite. A value is counted once before the bounds are added up."""
    edges = F.array(*(F.lit(float(b)) for b in bounds), F.lit(float("inf")))
    first = F.array_min(F.filter(edges, lambda x: F.col(value) <= x))
    counts = values.groupBy(*by, first.alias("le")).agg(F.count("*").alias("n"))
    spread = counts.withColumn("le", F.explode(F.filter(edges, lambda x: x >= F.col("le"))))
    present = spread.groupBy(*by, "le").agg(F.sum("n").alias("n"))
    grid = counts.select(*by).distinct().withColumn("le", F.explode(edges)) if by else None
    return present if grid is None else grid.join(present, [*by, "le"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def bucket_counters(values: DataFrame, bounds: list[float], by: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Samples (by, le, ts, value) of counters of the values up to each bound, the last being infinite, as they stand after each second with values.

    Values are counted by second first; the counters run within pieces of bounded size, so none is one task.
    """
    edges = [*map(float, bounds), float("inf")]
    names = [f"__n{i}" for i in range(len(edges))]
    counts = values.groupBy(*by, ts).agg(*(F.count_if(F.col(value) <= b).alias(n) for b, n in zip(edges, names, strict=True)))
    rows = summed_before(pieced(counts, ts), by, ts, names, [f"{n}_before" for n in names])
    counters = F.array(*(F.struct(F.lit(b).alias("le"), (F.col(f"{n}_before") + F.col(n)).alias("value")) for b, n in zip(edges, names, strict=True)))
    return rows.select(*by, ts, F.inline(counters))


def histogram_quantile(buckets: DataFrame, q: float, by: list[str]) -> DataFrame:
    """The q-quantile by linear interpolation in the first bucket that reaches it; in the infinite one, the last finite bound."""
    w = Window.partitionBy(*by).orderBy("le")
    rows = buckets.withColumn("below", F.coalesce(F.lag("n").over(w), F.lit(0))).withColumn("low", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
    rows = rows.withColumn("rank", q * F.max("n").over(Window.partitionBy(*by)))
    hit = rows.where("n >= rank").groupBy(*by).agg(F.min_by(F.struct("le", "n", "below", "low", "rank"), "le").alias("r"))
    inside = F.col("r.low") + (F.col("r.le") - F.col("r.low")) * F.coalesce(F.try_divide(F.col("r.rank") - F.col("r.below"), F.col("r.n") - F.col("r.below")), F.lit(0.0))
    return hit.select(*by, F.when(F.col("r.le") == float("inf"), F.col("r.low")).otherwise(inside).alias("quantile"))


def staleness(df: DataFrame, now: Column, by: list[str], time: str, healthy_s: int = 60) -> DataFrame:
    """The age in seconds of each series' last row at now, and its health: healthy up to healthy_s, unhealthy beyond or if there is none."""
    age = F.unix_micros(now) / 1e6 - F.unix_micros(F.max(time)) / 1e6
    out = df.groupBy(*by).agg(age.alias("age_s"))
    return out.withColumn("health", health(F.col("age_s"), healthy_s))


def health(age: Column, healthy_s: int = 60) -> Column:
    return F.when(age <= healthy_s, "healthy").otherwise("unhealthy")


def level(value: Column, steps: list[tuple[float, str]], base: str = "green") -> Column:
    """The name of the highest step that value reaches."""
    out = F.lit(base)
    for at, name in sorted(steps):
        out = F.when(value >= at, name).otherwise(out)
    return out


def latency_percentiles(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """p50, p95, p99 (exact, between neighbours by linear interpolation), max and mean; labels without values have none."""
    rest = df.groupBy(*by).agg(F.max(value).alias("max"), F.avg(value).alias("mean"))
    found = quantiles(df, by, value, [0.5, 0.95, 0.99]).select(*by, F.col("q0").alias("p50"), F.col("q1").alias("p95"), F.col("q2").alias("p99"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in by]
    joined = rest.alias("r").join(found.alias("f"), same, "left") if by else rest.alias("r").crossJoin(found.alias("f"))
    return joined.select(*(F.col(f"r.{c}").alias(c) for c in by), "p50", "p95", "p99", "max", "mean")
