from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from compare import duck, rows
from edge_rows import ROWS
from test_exact_dedup import digest
from test_jaccard_join import brute
from test_mixing import expected
from test_quality import plain_features

from textloom.llm import quality, registry
from textloom.llm.common import table


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, data)
        if name != "sentencepiece":
            assert docs.columns == before.columns, name
        docs = corpus_pipeline.staged(docs, f"test-{name}")
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > 0
    assert all(r.round_trip for r in docs.collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]


def test_run_equals_the_stages(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0


def test_run_against_brute_force(spark, data):
    docs = table(spark, data, "documents")
    model = quality.QualityModel.fit(docs, table(spark, data, "labels"))
    left = []
    for r in docs.select("doc_id", "text", "source").collect():
        own = plain_features(r.text or "")
        if model.bias + (float(np.mean(model.added[own])) if own else 0.0) >= 0:
            left.append((r.doc_id, r.text, r.source))
    last = {}
    for r in sorted(left):
        last[digest(r[1])] = r
    left = list(last.values())
    component = {i: c for i, _, c in brute([(i, t) for i, t, _ in left])}
    left = [r for r in left if component[str(r[0])] == str(r[0])]
    n = Counter(s for _, _, s in left)
    counts = expected([(i, t) for i, t, _ in left], [s for _, _, s in left], {s: k**0.5 for s, k in n.items()}, len(left))
    want = Counter({left[k][0]: c for k, c in counts.items()})
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, data).collect()) == want


def test_stages_on_edge_rows(spark, data, edge, nothing):
    """Nulls, ties, repeats and columns whose names stages use inside keep their values."""
    for docs, most in ((edge, len(ROWS)), (nothing, 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns, docs = docs.columns, corpus_pipeline.staged(stage(spark, docs, data), f"edge-{name}")
            assert docs.columns == columns
            assert {(r.group_size, r.copies, r.copy, r.score, r.keep_id) for r in docs.collect()} <= {(888, 777, 5, "x", "i")}
            assert name == "mixing" or docs.count() <= most
        assert stage is corpus_pipeline.STAGES[-2][1] and corpus_pipeline.STAGES[-1][1](spark, docs, data).count() == docs.count()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    ours, theirs = registry.queries()[name](spark, data).toPandas(), duck(data).execute(registry.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows(ours) == rows(theirs)
