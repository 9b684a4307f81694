"""Splits, quotas and mixes on a reproducible hash order; sizes follow the fixed rules, membership the order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import rules
from textloom.functions.text import shuffle_key

#: Hexadecimal digits of the hash that name a bucket.
BUCKET_DIGITS = 4


def _ranks(rows: DataFrame, key: str, groups: list[str]) -> DataFrame:
    """rows with __place from 1 within groups (null is a group) by hash order, and __size.

    A group would be one task's, so rows are dealt into 65,536 buckets a group by the first BUCKET_DIGITS of the
    hash, ranked within, and bucket offsets are added: of 100 TB in one group a bucket has 1.5 GB or so.
    """
    rows = rows.withColumn("__order", shuffle_key(F.col(key))).withColumn("__bucket", F.substring("__order", 1, BUCKET_DIGITS))
    sizes = rows.groupBy(*groups, "__bucket").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy(*groups).orderBy("__bucket")  # 65,536 rows at most
    whole = running.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    names = [*groups, "__bucket"]
    offsets = sizes.select(*[F.col(c).alias(f"__at_{k}") for k, c in enumerate(names)], (F.sum("n").over(running) - F.col("n")).alias("__before"), F.sum("n").over(whole).alias("__size"))
    if not groups:
        offsets = F.broadcast(offsets)  # 65,536 rows, two small numbers and four digits each
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__at_{k}")) for k, c in enumerate(names)])
    ranked = rows.join(offsets, same).withColumn("__place", F.col("__before") + F.row_number().over(Window.partitionBy(*names).orderBy("__order", key)))
    return ranked.drop("__bucket", "__before", *[f"__at_{k}" for k in range(len(names))])


def _drop(rows: DataFrame) -> DataFrame:
    return rows.drop("__order", "__place", "__size")


def split(rows: DataFrame, key: str, ratio: float = 0.9, groups: list[str] | None = None) -> DataFrame:
    """rows with split: the first floor(n * ratio) of the order are train, the rest val; per group if given."""
    ranked = _ranks(rows, key, groups or [])
    return _drop(ranked.withColumn("split", F.when(F.col("__place") <= F.floor(F.col("__size") * ratio), "train").otherwise("val")))


def stratified_split(rows: DataFrame, key: str, tier: str, share: float = 0.10) -> DataFrame:
    """rows with split: of each tier the first max(1, floor(n * share)) are val."""
    ranked = _ranks(rows, key, [tier])
    return _drop(ranked.withColumn("split", F.when(F.col("__place") <= F.greatest(F.lit(1), F.floor(F.col("__size") * share)), "val").otherwise("train")))


def weighted_sample(rows: DataFrame, key: str, tier: str, weights: dict[str, float], target: int) -> DataFrame:
    """Up to floor(target * weight) rows of each tier; a small tier is taken whole and not made up for."""
    wanted = F.lit(0)
    for name, weight in weights.items():
        wanted = F.when(F.col(tier) == name, F.lit(int(target * weight))).otherwise(wanted)
    return _drop(_ranks(rows, key, [tier]).where(F.col("__place") <= wanted))


def quota_mix(rows: DataFrame, key: str, pool: str, content: str, shares: list[tuple[str, float]] | None = None, total: int = rules.MIX_TOTAL) -> DataFrame:
    """Quotas by pool without repeated content, earlier pools first, and a shortfall made up from the first pool.

    rows with role: 'quota' or 'backfill'. A pool stops at its quota, so content it did not take is free
    for later pools; each pool leaves out only what earlier ones took.
    """
    shares = shares or rules.MIX_SHARES
    quotas = [int(total * share) for _, share in shares[:-1]]
    quotas.append(total - sum(quotas))
    first = Window.partitionBy(content).orderBy("__order", key)
    ordered = rows.withColumn("__order", shuffle_key(F.col(key)))
    taken: DataFrame | None = None
    chosen: list[DataFrame] = []
    for (name, _), quota in zip(shares, quotas, strict=True):
        own = ordered.where(F.col(pool) == name)
        if taken is not None:
            own = own.join(taken, content, "left_anti")
        own = own.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth").orderBy("__order", key).limit(quota)
        chosen.append(own.withColumn("role", F.lit("quota")))
        taken = own.select(content) if taken is None else taken.unionByName(own.select(content))
    have = taken.agg(F.count(F.lit(1)).alias("have"))
    spare = ordered.where(F.col(pool) == shares[0][0]).join(taken, content, "left_anti").withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth")
    ranked = spare.orderBy("__order", key).limit(total).withColumn("__place", F.row_number().over(Window.orderBy("__order", key)))  # total rows at most
    backfill = ranked.join(F.broadcast(have)).where(F.col("__place") <= total - F.col("have")).drop("__place", "have").withColumn("role", F.lit("backfill"))
    return reduce(DataFrame.unionByName, [*chosen, backfill]).select(*rows.columns, "role")


def slots_with_replacement(rows: DataFrame, key: str, tier: str, quotas: dict[str, int], seed: int = 42) -> DataFrame:
    """slot, tier and key of the row each slot draws; an empty tier draws from all rows.

    A slot draws rank h mod n of its pool, h being 32 bits of a hash of tier and slot.
    """
    spark = rows.sparkSession
    slots = spark.createDataFrame(list(quotas.items()), "slot_tier string, quota int").select("slot_tier", F.explode(F.sequence(F.lit(0), F.col("quota") - 1)).alias("slot"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), "slot_tier", F.lit("/"), F.col("slot").cast("string"))), 1, 8), 16, 10).cast("long")
    by_tier = _ranks(rows.select(key, tier), key, [tier]).select(F.col(tier).alias("pool"), (F.col("__place") - 1).cast("long").alias("rank"), F.col("__size").alias("n"), key)
    everything = _ranks(rows.select(key), key, []).select(F.lit("*").alias("pool"), (F.col("__place") - 1).cast("long").alias("rank"), F.col("__size").alias("n"), key)
    pools = by_tier.where(F.col("pool").isin(list(quotas))).unionByName(everything)
    sizes = pools.groupBy("pool").agg(F.max("n").alias("n"))
    own = slots.join(F.broadcast(sizes), slots["slot_tier"] == sizes["pool"], "left").select("slot_tier", "slot", F.col("n").alias("own_n"))
    all_n = F.broadcast(sizes.where("pool = '*'").select(F.col("n").alias("all_n")))
    drawn = own.join(all_n).select("slot_tier", "slot", F.when(F.col("own_n").isNotNull(), F.col("slot_tier")).otherwise("*").alias("pool"), (draw % F.coalesce("own_n", "all_n")).alias("rank"))
    return drawn.join(pools.drop("n"), ["pool", "rank"]).select(F.col("slot_tier").alias("tier"), "slot", key)


def head(rows: DataFrame, order: list, n: int) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def seeded_number(tier: Column, slot: Column, seed: int = 42) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), tier, F.lit("/"), slot.cast("string"))), 1, 8), 16, 10).cast("long")
