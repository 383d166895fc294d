"""Schemas and keys of the stored tables. Prices and quantities have 8 decimal places, which products keep exactly."""

from __future__ import annotations

DECIMAL = "decimal(18,8)"
TABLES = {
    "trades": f"time timestamp, symbol string, trade_id bigint, price {DECIMAL}, qty {DECIMAL}, buyer_is_maker boolean, event_time timestamp, received_at timestamp",
    "depth_updates": "time timestamp, symbol string, first_update_id bigint, final_update_id bigint, bids array<array<string>>, asks array<array<string>>, received_at timestamp",
    "depth_gaps": "time timestamp, symbol string, prev_final_update_id bigint, first_update_id bigint, missing_update_ids bigint, cause string, received_at timestamp",
    "features": "time timestamp, symbol string, trade_count int, volume double, notional double, spread_bps double, mid double, abs_return_bps double",
    "anomaly_flags": "time timestamp, symbol string, detector string, score double, threshold double, features map<string,double>",
}

#: Key of each table; the first row of a key by arrival stays.
KEYS = {
    "trades": ["symbol", "trade_id", "time"],
    "depth_updates": ["symbol", "final_update_id", "time"],
    "depth_gaps": ["symbol", "prev_final_update_id", "first_update_id"],
    "features": ["symbol", "time"],
    "anomaly_flags": ["symbol", "detector", "time"],
}
#: Tables that are partitioned by the day of their time.
DAILY = ("trades", "depth_updates", "features", "anomaly_flags")
#: Columns that may be null; all others may not. Fixed values.
NULLABLE = {"features": ("spread_bps", "mid", "abs_return_bps")}
#: Values that a column may have. Fixed values.
ALLOWED = {"depth_gaps": {"cause": ("stream", "reconnect")}}


def broken(table: str):
    """The names of the constraints that a row of a table breaks, an array: `column is null` and `column has another value`."""
    from pyspark.sql import functions as F

    names = [f.strip().split(" ", 1)[0] for f in TABLES[table].split(", ")]
    nulls = [F.when(F.col(n).isNull(), f"{n} is null") for n in names if n not in NULLABLE.get(table, ())]
    others = [F.when(~F.col(n).isin(*values), f"{n} has another value") for n, values in ALLOWED.get(table, {}).items()]
    return F.array_compact(F.array(*nulls, *others))


def enforced(df, table: str):
    """df, whose rows are checked as they are read: one that breaks a constraint ends the job, with what it breaks in the message."""
    from pyspark.sql import functions as F

    found = broken(table)
    return df.where(F.when(F.size(found) == 0, True).otherwise(F.raise_error(F.concat(F.lit(f"{table}: "), F.array_join(found, ", "))).cast("boolean")))


def conformed(df, table: str):
    """The columns of a table, in its types and order, and seq where there is one."""
    from pyspark.sql import functions as F

    fields = [f.strip().split(" ", 1) for f in TABLES[table].split(", ")]
    return df.select(*(["seq"] if "seq" in df.columns else []), *(F.col(n).cast(t).alias(n) for n, t in fields))
