import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.streaming import limited as op

SCHEMA = "category string, text string, n long"


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return {name: f"file://{tmp_path}/{name}" for name in ("in", "out", "cp")}


def add(spark, folders, rows, files=3):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(folders["in"])


def run(spark, folders, limit=10, there=None, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(folders["in"])
    query = op.append_limited(stream, folders["out"], folders["cp"], F.md5("text"), "category", limit, there=there, **options)
    assert query.awaitTermination(100)
    return [tuple(r) for r in spark.read.schema(SCHEMA).parquet(folders["out"]).collect()]


def counts(found):
    assert len({t for _, t, _ in found}) == len(found)  # no content twice
    return Counter(c for c, _, _ in found)


def test_late_and_repeated_rows_never_pass_the_limit(spark, folders):
    first = [("hot", f"t{k % 6}", k) for k in range(60)] + [("small", "a", 1), (None, "b", 2), (None, None, 3)]
    add(spark, folders, first)
    assert counts(run(spark, folders)) == {"hot": 6, "small": 1, None: 2}
    add(spark, folders, first + [("hot", f"u{k}", k) for k in range(50)] + [("small", "c", 1), ("small", "t1", 9)])
    found = run(spark, folders)
    assert counts(found) == {"hot": 10, "small": 2, None: 2}
    add(spark, folders, [("hot", f"v{k}", k) for k in range(50)])
    assert run(spark, folders) == found or counts(run(spark, folders)) == {"hot": 10, "small": 2, None: 2}


def test_a_replayed_batch_appends_nothing(spark, folders, tmp_path):
    add(spark, folders, [("hot", f"t{k}", k) for k in range(7)] + [("cold", f"c{k}", k) for k in range(4)], 1)
    found = run(spark, folders)
    commits = tmp_path / "cp" / "commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if (commits / name).exists():
            (commits / name).unlink()  # as if the driver had died before it could commit
    again = run(spark, folders)
    assert sorted(again) == sorted(found) and counts(again) == {"hot": 7, "cold": 4}
    add(spark, folders, [("hot", f"w{k}", k) for k in range(7)])
    assert counts(run(spark, folders)) == {"hot": 10, "cold": 4}


def test_the_table_that_is_there_counts(spark, folders):
    there = spark.createDataFrame([("hot", f"t{k}", k) for k in range(8)] + [("full", f"f{k}", k) for k in range(12)], SCHEMA)
    add(spark, folders, [("hot", f"t{k}", k) for k in range(20)] + [("full", "new", 1), ("fresh", "f0", 1), ("fresh", "x", 1)])
    found = run(spark, folders, there=there)
    assert counts(found) == {"hot": 2, "fresh": 1} and all(int(t[1:]) >= 8 for c, t, _ in found if c == "hot")


def test_only_so_many_of_a_task_go_on(spark):
    df = spark.createDataFrame([("hot" if k % 3 else "cold", str(k), k) for k in range(300)], SCHEMA).repartition(2)
    assert {r["category"]: r["count"] for r in op.head_of_task(df, "category", 20).groupBy("category").count().collect()} == {"hot": 40, "cold": 40}


def test_keys_under_a_time_to_live(spark, folders, request):
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled"))
    add(spark, folders, [("a", f"t{k % 3}", k) for k in range(12)])
    assert counts(run(spark, folders, ttl_ms=3_600_000)) == {"a": 3}
    add(spark, folders, [("a", f"t{k % 5}", k) for k in range(12)])
    assert counts(run(spark, folders, ttl_ms=3_600_000)) == {"a": 5}
