"""The driver's events table as an archive of raw frames, and the same in SQL.

Purchases are trades, views and clicks quotes, signups depth updates. Errors are connection markers (k below 50),
frames of another kind (even k) or malformed ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.plans.replay import Settings

#: The events are sparse: five-minute buckets and shorter windows.
SETTINGS = Settings(width_us=300_000_000, window=48, min_samples=12, train_window=400, refit_every=200, swap_after=10, quantile=0.99)
WIDTH_S = 300


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id is not null and ts is not null")
    return rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("symbol"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, received_at and payload, a frame for each event."""
    rows = events(spark, sf_dir)
    ms = (F.unix_micros("ts") / 1000).cast("bigint").cast("string")
    rn = F.row_number().over(Window.partitionBy("symbol", "event_type").orderBy("ts", "event_id"))
    rows = rows.withColumn("rn", rn)
    money = lambda c: c.cast("decimal(18,8)").cast("string")
    symbol, k, value = F.col("symbol"), F.col("k"), F.col("value")

    def frame(kind: str, *pairs) -> F.Column:
        stream = F.concat(F.lit('{"stream":"'), F.lower(symbol), F.lit(f'@{kind}","data":{{'))
        return F.concat(stream, F.concat_ws(",", *(F.concat(F.lit(f'"{n}":'), v) for n, v in pairs)), F.lit("}}"))

    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    number = lambda c: c.cast("bigint").cast("string")
    trade = frame("trade", ("e", F.lit('"trade"')), ("E", ms), ("s", text(symbol)), ("t", number(F.col("event_id"))), ("p", text(money(value))), ("q", text(money(k / 100.0))), ("T", ms), ("m", F.lit("true")))
    quote = frame("bookTicker", ("u", number(F.col("event_id"))), ("s", text(symbol)), ("b", text(money(value))), ("B", F.lit('"1"')), ("a", text(money(value * (10000 + k) / 10000.0))), ("A", F.lit('"1"')))
    first = F.col("rn") * 10 + F.when(k % 10 == 0, 3).when(k % 10 == 1, -2).otherwise(0)
    levels = F.concat(F.lit('[["'), money(value), F.lit('","'), number(k), F.lit('"]]'))
    depth = frame("depth@100ms", ("e", F.lit('"depthUpdate"')), ("E", ms), ("s", text(symbol)), ("U", number(first)), ("u", number(F.col("rn") * 10 + 9)), ("b", levels), ("a", F.lit("[]")))
    other = F.lit('{"stream":"x@kline_1m","data":{"e":"kline","k":{}}}')
    payload = (
        F.when((F.col("event_type") == "purchase") & (value > 0), trade)
        .when(F.col("event_type").isin("view", "click") & (value > 0), quote)
        .when(F.col("event_type") == "signup", depth)
        .when((F.col("event_type") == "error") & (k < 50), "#connected")
        .when((F.col("event_type") == "error") & (k % 2 == 0), other)
        .otherwise("not json")
    )
    return rows.select(F.struct("ts", "event_id").alias("seq"), F.col("ts").alias("received_at"), payload.alias("payload"))


#: The same records, straight from the events.
SQL = """
ev AS (SELECT event_id, ts, epoch_us(ts) AS us, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'S' || (user_id % 4) AS symbol FROM events),
trades AS (SELECT event_id, ts AS received_at, us, epoch_ms(epoch_us(ts) // 1000) AS time, symbol, event_id AS trade_id,
    CAST(value AS DECIMAL(18,8)) AS price, CAST(k / 100.0 AS DECIMAL(18,8)) AS qty FROM ev WHERE event_type = 'purchase' AND value > 0),
quotes AS (SELECT event_id, ts AS received_at, us, symbol, event_id AS update_id,
    CAST(CAST(value AS DECIMAL(18,8)) AS DOUBLE) AS bid, CAST(CAST(value * (10000 + k) / 10000.0 AS DECIMAL(18,8)) AS DOUBLE) AS ask
    FROM ev WHERE event_type IN ('view', 'click') AND value > 0),
dn AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) AS rn FROM ev WHERE event_type = 'signup'),
depth AS (SELECT event_id, ts AS received_at, epoch_ms(epoch_us(ts) // 1000) AS time, symbol, k, value,
    rn * 10 + CASE WHEN k % 10 = 0 THEN 3 WHEN k % 10 = 1 THEN -2 ELSE 0 END AS first_update_id, rn * 10 + 9 AS final_update_id FROM dn),
markers AS (SELECT event_id, ts AS received_at FROM ev WHERE event_type = 'error' AND k < 50)
"""

GAPS_SQL = """
em AS (SELECT symbol, received_at, event_id, time, first_update_id, final_update_id, 0 AS m FROM depth
    UNION ALL SELECT NULL, received_at, event_id, NULL, NULL, NULL, 1 FROM markers),
ep AS (SELECT *, greatest(1, sum(m) OVER (ORDER BY received_at, event_id ROWS UNBOUNDED PRECEDING)) AS epoch FROM em),
gl AS (SELECT *, lag(final_update_id) OVER w AS prev_final_update_id, lag(epoch) OVER w AS before FROM ep WHERE m = 0 WINDOW w AS (PARTITION BY symbol ORDER BY received_at, event_id)),
gaps AS (SELECT time, symbol, prev_final_update_id, first_update_id, first_update_id - prev_final_update_id - 1 AS missing_update_ids,
    CASE WHEN epoch > before THEN 'reconnect' ELSE 'stream' END AS cause, received_at
    FROM gl WHERE prev_final_update_id IS NOT NULL AND first_update_id <> prev_final_update_id + 1)
"""

_W = WIDTH_S * 1_000_000
FEATURES_SQL = f"""
xs AS (SELECT received_at, event_id, us, symbol, price, qty, NULL::DOUBLE AS mid, NULL::DOUBLE AS spread FROM trades
    UNION ALL SELECT received_at, event_id, us, symbol, NULL, NULL, (bid + ask) / 2, (ask - bid) / ((bid + ask) / 2) * 1e4 FROM quotes),
xb AS (SELECT *, max(us // {_W} * {_W}) OVER (ORDER BY received_at, event_id ROWS UNBOUNDED PRECEDING) AS b FROM xs),
cl AS (SELECT b, lead(b) OVER (ORDER BY b) AS nb, lag(b) OVER (ORDER BY b) AS pb FROM (SELECT DISTINCT b FROM xb)),
er AS (SELECT b, nb, max(CASE WHEN pb IS NULL OR b - pb > 6 * {_W} THEN b END) OVER (ORDER BY b ROWS UNBOUNDED PRECEDING) AS era,
    CASE WHEN nb - b > 6 * {_W} THEN b ELSE nb - {_W} END AS upto FROM cl),
bk AS (SELECT era, unnest(generate_series(b, upto, {_W})) AS k FROM er WHERE upto IS NOT NULL),
sy AS (SELECT symbol, min(b) AS first FROM xb GROUP BY symbol),
gr AS (SELECT symbol, era, k FROM bk JOIN sy ON k >= first),
tc AS (SELECT symbol, b AS k, CAST(count(*) AS INTEGER) AS trade_count, CAST(sum(qty) AS DOUBLE) AS volume, sum(CAST(round(price * 100) AS BIGINT) * CAST(round(qty * 100) AS BIGINT)) / 10000 AS notional FROM xb WHERE mid IS NULL GROUP BY ALL),
qe AS (SELECT xb.*, er.era FROM xb JOIN er USING (b) WHERE mid IS NOT NULL),
qn AS (SELECT *, lead(b) OVER w AS next_b, lead(us) OVER w AS next_us FROM qe WINDOW w AS (PARTITION BY symbol, era ORDER BY received_at, event_id)),
hd AS (SELECT g.symbol, g.k, q.spread, greatest(0, CASE WHEN q.next_b = g.k THEN q.next_us ELSE g.k + {_W} END - greatest(q.us, g.k)) AS held
    FROM gr g JOIN qn q ON q.symbol = g.symbol AND q.era = g.era AND q.b <= g.k AND (q.next_b IS NULL OR q.next_b >= g.k)),
sp AS (SELECT symbol, k, sum(spread * held) / nullif(sum(held), 0) AS spread_bps FROM hd GROUP BY ALL),
mi AS (SELECT symbol, era, b AS k, arg_max(mid, (received_at, event_id)) AS own FROM qe GROUP BY ALL),
gm AS (SELECT g.*, last_value(own IGNORE NULLS) OVER (PARTITION BY g.symbol, g.era ORDER BY g.k ROWS UNBOUNDED PRECEDING) AS mid FROM gr g LEFT JOIN mi USING (symbol, era, k)),
features AS (SELECT make_timestamp(gm.k) AS time, gm.symbol, coalesce(trade_count, 0) AS trade_count, coalesce(volume, 0) AS volume, coalesce(notional, 0) AS notional, spread_bps, mid,
    abs(ln(mid / lag(mid) OVER (PARTITION BY gm.symbol, gm.era ORDER BY gm.k))) * 1e4 AS abs_return_bps
    FROM gm LEFT JOIN tc USING (symbol, k) LEFT JOIN sp USING (symbol, k))
"""

_NAMES = ("log_trade_count", "log_notional", "spread_bps", "log_abs_return_bps")
ZSCORE_SQL = f"""
vec AS (SELECT *, ln(1 + trade_count) AS x_log_trade_count, ln(1 + notional) AS x_log_notional, spread_bps AS x_spread_bps, ln(1 + abs_return_bps) AS x_log_abs_return_bps,
    row_number() OVER (PARTITION BY symbol ORDER BY time) AS seen FROM features WHERE spread_bps IS NOT NULL AND abs_return_bps IS NOT NULL),
st AS (SELECT *, count(*) OVER w AS n, quantile_cont(x_spread_bps, 0.5) OVER w AS med, {", ".join(f"avg(x_{n}) OVER w AS m_{n}, stddev_pop(x_{n}) OVER w AS s_{n}" for n in _NAMES)}
    FROM vec WINDOW w AS (PARTITION BY symbol ORDER BY seen ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING)),
sd AS (SELECT * REPLACE ({", ".join((f"greatest(CASE WHEN s_{n} <= 1e-9 * greatest(1, abs(m_{n})) THEN 0 ELSE s_{n} END, 0.5 * med) AS s_{n}" if n == "spread_bps" else f"CASE WHEN s_{n} <= 1e-9 * greatest(1, abs(m_{n})) THEN 0 ELSE s_{n} END AS s_{n}") for n in _NAMES)}) FROM st),
zz AS (SELECT *, {", ".join(f"CASE WHEN n >= 12 THEN CASE WHEN s_{n} > 0 THEN (x_{n} - m_{n}) / s_{n} ELSE 0 END END AS z_{n}" for n in _NAMES)} FROM sd),
zscores AS (SELECT *, greatest({", ".join(f"abs(z_{n})" for n in _NAMES)}) AS score, 4.0 AS threshold FROM zz)
"""
#: A second, cheap scorer for the comparison: the return alone.
COMPARED_SQL = """
scored AS (SELECT symbol, time, x_log_trade_count, x_log_notional, x_spread_bps, x_log_abs_return_bps, round(score, 6) AS a_score, round(score, 6) > 4.0 AS a_flag,
    round(x_log_abs_return_bps, 6) AS b_score, round(x_log_abs_return_bps, 6) > 9.5 AS b_flag FROM zscores WHERE score IS NOT NULL)
"""
