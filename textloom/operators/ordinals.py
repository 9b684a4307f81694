"""Exact places in an order, within groups of any size, without a task that holds a group."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of one group that one task adds up in running values.
CHUNK = 1 << 12


def _same(names: list[str], others: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(names, others, strict=True)])


def with_ordinals(rows: DataFrame, groups: list[str], order: list, name: str = "ordinal", keep: Callable[[DataFrame], DataFrame] = lambda df: df.checkpoint()) -> DataFrame:
    """rows with their place from 1 within their group, as row_number has it; rows without groups are one group.

    Rows are dealt into ranges of group and order, so a large group is cut at quantiles of its own; a
    row's place is its place within its range, and what earlier ranges hold of its group comes before. Nulls
    make a group like any value, order takes column names and sort expressions, and rows that tie there
    come in the order in which they are read. The ranges are written once (``keep``), since places must not
    change between reading and counting; all other columns go along, so bring only those that are needed.
    """
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    keys = [*groups, *order, "__tie"]
    placed = keep(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie").withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__range", F.shiftright("__at", 33))
    names = [*groups, "__range"]
    counts = placed.groupBy(*names).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range at most
    start = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1
    others = [f"__of_{k}" for k in range(len(names))]
    starts = counts.select(*[F.col(c).alias(o) for c, o in zip(names, others, strict=True)], start.alias("__start"))
    return placed.join(starts, _same(names, others)).withColumn(name, F.col("__at") + F.col("__start")).select(*rows.columns, name)


#: How the values of two parts come together.
MERGES = {F.sum: Column.__add__, F.bit_xor: Column.bitwiseXOR, F.max: F.greatest, F.min: F.least}


def with_running(rows: DataFrame, group: str, place: str, values: dict[str, Column], add: Callable[[Column], Column] = F.sum) -> DataFrame:
    """rows with running aggregates of their group in ascending place, the own row included: {new column: aggregate of}.

    place: integers, distinct within a group; group may not be null. A group is cut into chunks of CHUNK
    places, added up each by itself and then over chunks, so no task holds a group. ``add`` is one of
    MERGES; nulls are passed over, and a value is null while all before it are.
    """
    cut = rows.withColumn("__chunk", F.floor(F.col(place) / CHUNK).cast("long"))
    within = Window.partitionBy(group, "__chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    chunks = cut.groupBy(group, "__chunk").agg(*[add(x).alias(f"__sum_{c}") for c, x in values.items()])
    earlier = Window.partitionBy("__of").orderBy("__number").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.withColumnsRenamed({group: "__of", "__chunk": "__number"}).withColumns({f"__before_{c}": add(F.col(f"__sum_{c}")).over(earlier) for c in values})
    before = before.where(reduce(lambda x, y: x | y, [F.col(f"__before_{c}").isNotNull() for c in values])).drop(*[f"__sum_{c}" for c in values])
    local = cut.withColumns({f"__own_{c}": add(x).over(within) for c, x in values.items()})
    joined = local.join(before, (F.col(group) == F.col("__of")) & (F.col("__chunk") == F.col("__number")), "left")
    merged = {c: F.coalesce(MERGES[add](F.col(f"__own_{c}"), F.col(f"__before_{c}")), f"__own_{c}", f"__before_{c}") for c in values}
    return joined.withColumns(merged).select(*rows.columns, *values)
