"""Connected components of a graph of links, by the least label reached, with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import met, settled


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and label (the least node of its component) for every node of links.

    Each round takes the least label among a node and its neighbours, then follows labels once more, so paths halve and
    few rounds are needed. Minima are formed before the shuffle, no neighbourhood is gathered, and hubs are dealt out. Each round is written
    to the shared folder. Self-links only name a node; repeated links do no harm; no links give no rows.
    """
    both = links.select(F.col(a).alias("s"), F.col(b).alias("t")).unionAll(links.select(F.col(b).alias("s"), F.col(a).alias("t")))
    edges = settled(both.distinct(), "cc-edges")
    labels = settled(edges.groupBy("s").agg(F.min("t").alias("m")).select(F.col("s").alias("node"), F.least("s", "m").alias("label")), "cc")
    while True:
        # a node that many others are linked with, and a label that many have, go to several tasks
        heard = met(edges, labels.select(F.col("node").alias("t"), "label"), "t").groupBy("s").agg(F.min("label").alias("m"))
        nearer = settled(labels.join(heard.withColumnRenamed("s", "node"), "node").select("node", "label", F.least("label", "m").alias("m")), "cc-near")
        up = nearer.select(F.col("node").alias("m"), F.col("m").alias("mm")).join(nearer.select("m").distinct(), "m")
        jumped = settled(met(nearer, settled(up, "cc-up"), "m", "left").select("node", F.col("label").alias("old"), F.coalesce("mm", "m").alias("label")), "cc")
        labels = jumped.select("node", "label")
        if jumped.where("old <> label").isEmpty():
            return labels
