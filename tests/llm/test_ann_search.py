import numpy as np
from pyspark.sql import functions as F

from textloom.llm import ann_search as op


def exact(rows, queries, k):
    out = {}
    for q in queries:
        own = rows[q]
        near = sorted((float(np.sqrt(((np.array(own, float) - np.array(v, float)) ** 2).sum())), i) for i, v in rows.items() if i != q and len(v) == len(own))
        out[q] = near[:k]
    return out


def test_recall_and_exact_scores(spark):
    random = np.random.default_rng(1)
    centres = random.normal(size=(40, 24))
    rows = {i: [float(x) for x in (centres[i % 40] + 0.7 * random.normal(size=24)).astype("float32")] for i in range(3000)}
    table = spark.createDataFrame([(i, v, "x") for i, v in rows.items()], "vec_id long, embedding array<float>, rank string")
    got = op.nearest(table, F.col("vec_id") % 100 == 0).collect()
    want, hits = exact(rows, range(0, 3000, 100), 10), 0
    for q in want:
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1))
        assert [(s, v) for _, v, s in own] == sorted((s, v) for _, v, s in own)
        distance = {i: np.sqrt(((np.array(rows[q]) - np.array(rows[i])) ** 2).sum()) for _, i, _ in own}
        assert all(abs(s - distance[v]) < 1e-9 for _, v, s in own)
        hits += len({v for _, v, _ in own} & {i for _, i in want[q]})
    assert hits >= 0.95 * 300


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, None), (200, [0.0, 0.0]), (300, [nan, 1.0]), (400, [inf, 1.0]), (500, [None, 1.0]), (600, []), (None, [1.0, 1.0]), (1, [1.0, 0.1]), (1, [1.0, 0.1]), (2, [1.0, 0.0, 0.0]), (700, [3.0])]
    rows += [(10 + k, [0.5, 0.5]) for k in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in op.nearest(table, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert sorted(got) == [0] and [v for _, v in sorted(got[0])] == [1, *range(10, 19)]
    assert op.nearest(table.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_a_common_vector_s_own_query(spark):
    rows = [(100 * k, [0.6, 0.8]) for k in range(30)]
    got = [(r.query_id, r.vec_id) for r in op.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect()]
    assert len(got) == 300
    assert sorted(v for q, v in got if q == 2900) == [100 * k for k in range(10)]


def test_a_share_of_the_table_is_looked_at(spark):
    """Recall and candidates against brute force, with a dense cluster among the rest."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(6000, 32))
    x[:1000] = x[0] + draw.normal(size=(1000, 32)) * 0.05
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    queries = np.arange(0, 6000, 100)
    gap = ((x[queries][:, None] - x[None]) ** 2).sum(2)
    gap[np.arange(len(queries)), queries] = np.inf
    true = {int(q): set(np.argsort(g, kind="stable")[:10].tolist()) for q, g in zip(queries, gap, strict=True)}
    got = op.nearest(table, F.col("vec_id") % 100 == 0).collect()
    assert sum(r.vec_id in true[r.query_id] for r in got) >= 0.9 * 10 * len(queries)
    rows = op.usable(table, "vec_id", "embedding")
    maker = {32: op.CrossPolytope(32, 6000, op.TABLES, op.BUCKET_SIZE)}
    probed = op._hashed(rows.where("vec_id % 100 = 0"), maker, {32: op.PROBES}).withColumnRenamed("vec_id", "query_id")
    found = probed.join(op._hashed(rows, maker, None), ["dimension", "table", "bucket"]).select("query_id", "vec_id").distinct().count()
    assert found < 0.5 * len(queries) * 6000
