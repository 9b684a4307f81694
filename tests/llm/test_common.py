import os
from concurrent.futures import ThreadPoolExecutor

import corpus_pipeline
import pytest
from compare import rows
from pyspark.sql import functions as F

from textloom.llm import registry
from textloom.llm.common import shared_dir, staged, temporary_tables


def tables(spark):
    folder = f"{shared_dir(spark)}/textloom".removeprefix("file://").removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_runs_side_by_side_keep_their_tables(spark, data):
    tasks = [registry.op5_jaccard_join, corpus_pipeline.run, registry.op5_jaccard_join]
    wanted = [rows(f(spark, data).toPandas()) for f in tasks[:2]]
    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(lambda f: rows(f(spark, data).toPandas()), tasks))
    assert found == [*wanted, wanted[0]]


def test_tables_go_with_their_block(spark):
    before = tables(spark)
    with temporary_tables(spark):
        with temporary_tables(spark):
            staged(spark.range(3), "inner")
            kept = staged(spark.range(4), "outer", outlives=True)
        assert kept.count() == 4 and {x.split("-")[0] for x in tables(spark) - before} == {"outer"}
    assert tables(spark) == before
    lasting = staged(spark.range(5), "lasting")
    assert lasting.count() == 5 and len(tables(spark) - before) == 1


def test_a_failed_run_leaves_no_table(spark):
    before = tables(spark)
    with pytest.raises(Exception, match="broken"), temporary_tables(spark):
        staged(spark.range(3), "whole")
        staged(spark.range(3).select(F.raise_error(F.lit("broken")).alias("x")), "part", outlives=True)
    assert tables(spark) == before


def test_the_pipeline_keeps_the_mix_alone(spark, data):
    before = tables(spark)
    corpus_pipeline.run(spark, data).count()
    assert [x.rsplit("-", 1)[0] for x in tables(spark) - before if x.startswith("pipeline")] == ["pipeline-mixing"]
