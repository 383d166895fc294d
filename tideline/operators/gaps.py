"""Breaks in the sequence of depth updates, and what caused them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.running import neighbour, pieced, running_sum


def detect_gaps(depth: DataFrame, markers: DataFrame) -> DataFrame:
    """A row for each depth update that doesn't begin right after its symbol's previous one.

    The cause is reconnect if the number of markers so far (at least one: the first marker is the first connection) rose
    since the previous update, else stream. missing_update_ids is negative for overlaps. Both inputs have seq, and piece
    where they have been cut already.
    """
    columns = ["time", "symbol", "first_update_id", "final_update_id", "received_at"]
    place = [c for c in ("seq", "piece") if c in depth.columns]
    rows = depth.select(*place, *columns, F.lit(0).alias("marker"))
    blank = markers.select(*place, *(F.lit(None).cast(depth.schema[c].dataType).alias(c) for c in columns), F.lit(1).alias("marker"))
    both = rows.unionByName(blank)
    counted = running_sum(both if "piece" in place else pieced(both, "seq"), F.col("marker"), "seq", "epoch").where("marker = 0").withColumn("epoch", F.greatest(F.lit(1), "epoch"))
    seen = neighbour(counted, ["symbol"], "seq", F.struct("final_update_id", "epoch"), "before")
    found = seen.withColumn("prev_final_update_id", F.col("before.final_update_id")).where("prev_final_update_id is not null and first_update_id <> prev_final_update_id + 1")
    return found.select(
        "seq", "time", "symbol", "prev_final_update_id", "first_update_id", (F.col("first_update_id") - F.col("prev_final_update_id") - 1).alias("missing_update_ids"),
        F.when(F.col("epoch") > F.col("before.epoch"), "reconnect").otherwise("stream").alias("cause"), "received_at",
    )
