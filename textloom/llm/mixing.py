"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the mixed corpus over its share now. Each document's
count inverts the Poisson distribution with that mean at a number seeded by a hash of its id, so counts
are the same on every run and add up to the target in expectation. Copies are then shuffled globally by
a hash of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.common import staged

SEED = 42
#: Share of a source in the mix goes with its count to this power, unless targets are given.
EXPONENT = 0.5


def unit_interval(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def tempered_targets(counts: DataFrame, exponent: float = EXPONENT) -> DataFrame:
    """source, weight: counts (source, n) raised to the exponent. Weights need not add up to one."""
    return counts.select("source", F.pow(F.col("n").cast("double"), F.lit(exponent)).alias("weight"))


def repetition_steps(counts: DataFrame, targets: DataFrame, total: int) -> DataFrame:
    """source, rate, steps: the cumulative Poisson probabilities of 0, 1, 2, ... up to where the rest is negligible."""
    whole = targets.agg(F.sum("weight").alias("whole"))
    rates = (
        counts.join(targets.select(F.col("source").alias("target"), "weight"), F.col("source").eqNullSafe(F.col("target")))
        .join(F.broadcast(whole))  # one row
        .select("source", F.coalesce(F.col("weight") / F.nullif("whole", F.lit(0.0)) * F.lit(float(total)) / F.col("n"), F.lit(0.0)).alias("rate"))
    )
    last = (F.ceil(F.col("rate") + 10 * F.sqrt("rate")) + 20).cast("int")
    by_k = rates.withColumn("k", F.explode(F.sequence(F.lit(0), last)))
    running = Window.partitionBy("source").orderBy("k")
    by_k = by_k.withColumn("ln_factorial", F.sum(F.when(F.col("k") > 1, F.ln("k")).otherwise(0.0)).over(running))
    ln_rate = F.when(F.col("rate") > 0, F.ln("rate"))
    mass = F.when(F.col("rate") > 0, F.exp(F.col("k") * ln_rate - F.col("rate") - F.col("ln_factorial"))).otherwise(F.when(F.col("k") == 0, 1.0).otherwise(0.0))
    by_k = by_k.withColumn("cdf", F.sum(mass).over(running))
    return by_k.groupBy("source").agg(F.first("rate").alias("rate"), F.array_sort(F.collect_list("cdf")).alias("steps"))


def _mixed(docs: DataFrame, targets: DataFrame | None = None, total: int | None = None, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs with __copy, __copies and __order_key; see mix_sources."""
    own = docs.withColumn("__source", F.col(source_col).cast("string"))
    counts = staged(own.groupBy(F.col("__source").alias("source")).agg(F.count(F.lit(1)).alias("n")), "source-counts")
    if total is None:
        total = counts.agg(F.sum("n")).first()[0] or 0
    steps = staged(repetition_steps(counts, targets if targets is not None else tempered_targets(counts), total), "repetition-steps")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    drawn = own.join(steps.select(F.col("source").alias("__step_source"), F.col("steps").alias("__steps")), F.col("__source").eqNullSafe(F.col("__step_source")))
    drawn = drawn.withColumn("__u", unit_interval(F.lit(str(seed)), F.lit("count"), key))
    drawn = drawn.withColumn("__copies", F.size(F.filter("__steps", lambda x: x <= F.col("__u")))).where("__copies > 0")
    copies = drawn.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    copies = copies.withColumn("__order_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"), key, F.col("__copy").cast("string"))))
    return copies.select(*docs.columns, "__copy", "__copies", "__order_key").repartition("__order_key").sortWithinPartitions("__order_key")


def mix_sources(docs: DataFrame, targets: DataFrame | None = None, total: int | None = None, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs, each row repeated by its Poisson count and shuffled; adds copy (from 1), copies and order_key.

    targets: (source, weight); by default the counts' EXPONENT power. total: rows of the mix in
    expectation, by default as many as now. Counts cover every row. A null source is a source of its own;
    a source without a target gives no row; rows with one id (null too) share its draw, repeated rows are
    all drawn. Null and empty texts are drawn like others. An empty table gives an empty mix. Columns of
    docs named copy, copies or order_key make way for those of the mix. The step table has a few dozen
    numbers a source and is written before the join, so that Spark broadcasts it only where its size is
    known to be small.
    """
    added = ("copy", "copies", "order_key")
    mixed = _mixed(docs, targets, total, seed, id_col, source_col)
    return mixed.select(*[c for c in docs.columns if c not in added], *[F.col(f"__{c}").alias(c) for c in added])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of mix_sources with the columns of docs alone, whatever their names and with their own values."""
    return _mixed(docs, **options).select(*docs.columns)
