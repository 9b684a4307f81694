import hashlib
import math
from collections import Counter

from edge_rows import ROWS

from textloom.llm import mixing as op


def poisson(rate, u):
    total, mass, k = 0.0, math.exp(-rate), 0
    while True:
        total += mass
        if u < total or k > 500:
            return k
        k += 1
        mass *= rate / k


def uniform(i, seed=op.SEED):
    return int(hashlib.md5(f"{seed}|count|{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2**52


def expected(rows, sources, targets, total):
    n = Counter(sources)
    whole = sum(targets.get(s, 0) for s in n)
    return Counter({k: c for k, (row, s) in enumerate(zip(rows, sources, strict=True)) if (c := poisson(targets.get(s, 0) / whole * total / n[s], uniform(row[0])))})


def test_counts_follow_the_inverse(edge):
    sources = ["s1" if (i or 0) % 3 else None for i, _ in ROWS]
    targets = {s: Counter(sources)[s] ** 0.5 for s in set(sources)}
    want = expected(ROWS, sources, targets, len(ROWS))
    got = op.mix_sources(edge).collect()
    assert len(got) == sum(want.values())
    assert Counter((r.doc_id, r.text) for r in got) == sum((Counter({ROWS[k]: c}) for k, c in want.items()), Counter())


def test_targets_and_shuffle(spark, docs_of):
    rows = [(i, f"t{i}") for i in range(4000)]
    docs = docs_of(rows)
    targets = spark.createDataFrame([("s1", 1.0), (None, 3.0), ("unseen", 5.0)], "source string, weight double")
    got = op.mix_sources(docs, targets.where("source is null or source <> 'unseen'"), 8000).collect()
    share = Counter(r.source for r in got)
    assert abs(share[None] - 6000) < 400 and abs(share["s1"] - 2000) < 250
    assert [r.doc_id for r in got[:50]] != sorted(r.doc_id for r in got[:50])
    assert {(r.doc_id, r.copy) for r in got} == {(r.doc_id, k) for r in got for k in range(1, r.copies + 1)}
    only = op.mix_sources(docs, targets.where("source = 's1'"), 100).collect()
    assert {r.source for r in only} == {"s1"}


def test_stage_keeps_columns(edge, nothing):
    mixed = op.mixed_documents(edge)
    assert mixed.columns == edge.columns
    assert {(r.copies, r.copy, r.order_key) for r in mixed.collect()} == {(777, 5, "o")}
    assert {r.copies for r in op.mix_sources(edge).collect()} != {777}
    assert op.mixed_documents(nothing).count() == 0
