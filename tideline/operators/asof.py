"""As-of joins: each row with the last row of another table that held at its time, by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.running import carried, pieced


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], *, tie: str | None = None, tolerance: int | None = None, strict: bool = False) -> DataFrame:
    """left with values (columns of right) of the last row of right whose on is not greater; null where there is none.

    on and, among equal ones, tie are the order; both tables have them, and by. A row of right with the same on and tie holds
    for the row of left, unless strict. With tolerance (in the unit of on; microseconds for timestamps) rows that are further
    back don't hold. Rows whose key or on is null find nothing, and hold for nothing; all rows of left are kept, repeated ones
    too. values mustn't be columns of left.

    Both tables are one stream along the order, cut into pieces of bounded size; what holds at the edge of a piece comes from
    a table with a row per piece and key. So neither a hot key nor a long silence makes a task larger.
    """
    order = [on, *([tie] if tie else [])]
    number = lambda df: F.unix_micros(on) if dict(df.dtypes)[on] == "timestamp" else F.col(on)
    # of equal places, the rows that hold come first unless strict
    place = lambda side: F.struct(*order, F.lit(side).alias("side"))
    known = F.col(on).isNotNull()
    for c in by:
        known = known & F.col(c).isNotNull()
    rows = left.where(known).select(*by, F.struct(*left.columns).alias("__row"), number(left).alias("__on"), place(1).alias("__o"))
    holds = right.where(known).select(*by, F.struct(F.struct(*values).alias("values"), number(right).alias("at")).alias("__held"), place(2 if strict else 0).alias("__o"))
    both = rows.unionByName(holds, allowMissingColumns=True)
    found = carried(pieced(both, "__o"), by, "__o", "__held", "__found").where("__row is not null")
    fits = F.lit(True) if tolerance is None else F.col("__on") - F.col("__found.at") <= tolerance
    met = found.select("__row.*", *(F.when(fits, F.col(f"__found.values.{v}")).alias(v) for v in values))
    return met.unionByName(left.where(~known), allowMissingColumns=True)
