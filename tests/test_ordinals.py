import random

import pytest
from compare import rows as plain_rows
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.operators import ordinals as op

SCHEMA = "g string, t int, x long, ordinal string"


def table(spark, n, seed=3):
    rng = random.Random(seed)
    rows = [("hot" if k % 3 else rng.choice([None, "a", "b", f"g{k % 50}"]), rng.choice([None, *range(9)]), k, "z") for k in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("groups", [["g"], [], ["g", "t"]])
def test_places_equal_row_number(spark, groups):
    df = table(spark, 3000)
    order = [F.desc_nulls_last("t"), F.col("x")]
    wanted = df.withColumn("place", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    assert plain_rows(op.with_ordinals(df, groups, order, "place").toPandas()) == plain_rows(wanted.toPandas())


def test_no_task_holds_a_group(spark, request):
    kept = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges stay apart
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))

    def keep(df):
        kept.append(df.checkpoint())
        return kept[-1]

    assert op.with_ordinals(table(spark, 4000).where("g = 'hot'"), ["g"], ["x"], keep=keep).agg(F.max("ordinal")).first()[0] == table(spark, 4000).where("g = 'hot'").count()
    sizes = [r["count"] for r in kept[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / 4


def test_equal_rows_are_spread_too(spark):
    df = spark.createDataFrame([("same", 1, 1, "")] * 2000, SCHEMA).repartition(5)
    found = op.with_ordinals(df, ["g"], ["t"], "place")
    assert sorted(r.place for r in found.collect()) == list(range(1, 2001))


def test_empty_table(spark):
    assert op.with_ordinals(table(spark, 3).limit(0), ["g"], ["x"]).count() == 0
    assert op.with_running(table(spark, 3).limit(0), "x", "t", {"s": F.col("x")}).count() == 0


@pytest.mark.parametrize("add", [F.sum, F.bit_xor, F.max, F.min])
def test_running_values_over_chunks(spark, monkeypatch, add):
    monkeypatch.setattr(op, "CHUNK", 7)
    df = table(spark, 300).where("g IS NOT NULL").withColumn("y", F.when(F.col("x") % 4 > 0, F.col("x") * 31 % 17))
    over = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    assert plain_rows(op.with_running(df, "g", "x", {"s": F.col("y"), "u": F.col("y") + 1}, add).toPandas()) == plain_rows(df.withColumns({"s": add("y").over(over), "u": add(F.col("y") + 1).over(over)}).toPandas())
