import os

import pytest
from pyspark.sql import functions as F

from textloom.sources import atomic as op

SCHEMA = "n long, t string"


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/log"


def rows_of(spark, start, n):
    return spark.range(start, start + n, 1, 4).select(F.col("id").alias("n"), F.concat(F.lit("line\n"), F.col("id").cast("string"), F.lit(" é")).alias("t"))


def stored(spark, path):
    return sorted((r.n, r.t) for r in op.read_whole(spark, path, SCHEMA).collect())


def test_appends_are_seen_whole(spark, path):
    assert stored(spark, path) == []
    op.append_whole(rows_of(spark, 0, 50), path)
    op.append_whole(rows_of(spark, 50, 30), path)
    op.append_whole(rows_of(spark, 0, 0), path)
    assert stored(spark, path) == [(k, f"line\n{k} é") for k in range(80)]


@pytest.mark.parametrize("how", ["error", "kill"])
def test_a_failed_append_leaves_no_row(spark, path, tmp_path, how):
    op.append_whole(rows_of(spark, 0, 10), path)

    def fail(batches):
        for batch in batches:
            yield batch
            if 900 in batch.column("n").to_pylist():
                os._exit(7) if how == "kill" else exec("raise ValueError('broken')")

    bad = rows_of(spark, 800, 200).mapInArrow(fail, SCHEMA)
    with pytest.raises(Exception, match="broken|exited|crashed|Job aborted|WRITE"):
        op.append_whole(bad, path)
    assert [n for n, _ in stored(spark, path)] == list(range(10))
    # a file that a killed task has left is in no manifest
    (tmp_path / "log" / "files" / "left-behind.jsonl").write_text('{"n": 5000, "t": "x"}\n')
    op.append_whole(rows_of(spark, 10, 5), path)
    assert [n for n, _ in stored(spark, path)] == list(range(15))


def test_a_transaction_is_committed_once(spark, path, tmp_path):
    for _ in range(3):
        op.append_whole(rows_of(spark, 0, 20), path, "batch-7")
    assert len(stored(spark, path)) == 20
    assert len(os.listdir(tmp_path / "log" / "files")) <= 4  # the later tries' files are gone


def test_nulls_and_other_writes(spark, path):
    op.append_whole(spark.createDataFrame([(1, None), (None, None)], SCHEMA), path)
    assert op.read_whole(spark, path, SCHEMA).count() == 2
    with pytest.raises(Exception, match="one column"):
        rows_of(spark, 0, 1).write.format(op.NAME).mode("append").option("path", path).save()
