import random

from pyspark.sql import functions as F

from textloom.operators import convert, dedup, stats
from textloom.plans.catalogue import QUERIES
from textloom.sources import counted, jsonl

SCHEMA = "id long, g string, t string"


def rows_of(spark, n=300):
    rng = random.Random(2)
    return [(k, "hot" if k % 3 else rng.choice([None, "a", "b"]), rng.choice(["bad", None, *[f"t{j}" for j in range(40)], "same", "same", "same"])) for k in range(n)]


def test_funnel_against_plain_loops(spark):
    data = rows_of(spark)
    found = {(r.is_total, r.g): (r.total, r.normalised, r.uniq, r.removed) for r in dedup.funnel(spark.createDataFrame(data, SCHEMA), "g", F.col("t") != "bad", F.col("t"), "id").collect()}
    seen, want = set(), {}
    for _, g, t in data:
        row = want.setdefault((False, g), [0, 0, 0])
        row[0] += 1
        if t not in ("bad", None):
            row[1] += 1
            row[2] += t not in seen
            seen.add(t)
    want[True, None] = [sum(x) for x in zip(*want.values(), strict=True)]
    assert found == {k: (a, b, c, a - c) for k, (a, b, c) in want.items()}


def test_funnel_reads_its_table_once(spark, data):
    plan = QUERIES["clean_funnel"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_examples_of_repeats(spark):
    data = rows_of(spark)
    found = [tuple(r) for r in dedup.duplicate_examples(spark.createDataFrame(data, SCHEMA), "id", F.col("t"), 7).orderBy("id").collect()]
    want, seen = [], {}
    for i, _, t in data:
        if t is not None:
            seen[t] = seen.get(t, 0) + 1
            if seen[t] > 1:
                want.append((i, t, seen[t], sum(x == t for *_, x in data)))
    assert found == want[:7]


def test_counts_beside_the_write(spark, tmp_path):
    df = spark.createDataFrame(rows_of(spark), SCHEMA)
    counts = counted.clean_and_count(df, f"file://{tmp_path}/out", F.col("t") != "bad", F.col("t"), ["id"])
    good = df.where("t <> 'bad'")
    assert counts == {"total": 300, "normalised": good.count(), "uniq": good.select("t").distinct().count(), "removed": 300 - good.select("t").distinct().count()}
    steps, _ = counted._steps(spark.read.parquet(f"file://{tmp_path}/out"), F.col("t") != "bad", F.col("t"), ["id"])
    assert steps._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert counted.clean_and_count(df.limit(0), f"file://{tmp_path}/none", F.lit(True), F.col("t"), ["id"])["uniq"] == 0


def test_missing_sources_are_left_out(spark, tmp_path):
    for name in ("b", "d"):
        (tmp_path / f"{name}.jsonl").write_text(f'{{"instruction": "{name}"}}\nbroken\n\n')
    paths = [f"file://{tmp_path}/{name}.jsonl" for name in "abcd"]
    found = jsonl.read_sources(spark, paths, jsonl.EXAMPLE)
    assert sorted((r.source_rank, r.source_file, r.instruction) for r in found.collect()) == [(1, "b.jsonl", "b"), (3, "d.jsonl", "d")]
    none = jsonl.read_sources(spark, paths[::2], jsonl.EXAMPLE)
    assert none.count() == 0 and none.columns == found.columns


def test_titles(spark):
    for text in ("owasp-top10 2fa", "they're HERE", "a1b2 Ünïcode éclair", "", "x__y", "漢abc 3D"):
        assert spark.range(1).select(convert.title_case(F.lit(text))).first()[0] == text.title()


def test_candidates_in_order(spark):
    df = spark.createDataFrame([(1, 0.5, "bb"), (2, 0.9, "long one"), (3, 0.9, "b"), (4, 0.9, "a"), (5, None, "z"), (6, 0.9, "a"), (7, 0.5, None)], "id int, c double, t string")
    assert [r.id for r in stats.ordered_candidates(df, "c", "t", 6, "id").collect()] == [4, 6, 3, 2, 7, 1]
