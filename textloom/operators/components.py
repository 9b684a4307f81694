"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def smallest_reached(links: DataFrame) -> DataFrame:
    """node, label: for every node of links (u, v), the smallest node that it is connected with.

    Large and small stars in turn, checkpointed at each step: the number of steps grows with the logarithm of
    a chain's length. Loops, repeated links and links with a null don't matter; no links give no rows.
    """
    now = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).checkpoint()
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = larger.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint()
        least = now.groupBy("u").agg(F.min("v").alias("m")).checkpoint()
        pulled = now.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        now = pulled.unionByName(least.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        before, state = state, _state(now)
        if before == state:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
