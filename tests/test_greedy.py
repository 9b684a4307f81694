import random
import re
from collections import deque

import pytest
from pyspark.sql import functions as F

from textloom.operators import greedy as op


def plain(rows, threshold, look_back):
    """One pass over the rows in order."""
    held, out = deque(maxlen=look_back), {}
    for i, text in sorted(rows):
        own = {w for w in re.findall(r"\w+", (text or "").lower()) if re.fullmatch("[a-z0-9_]{3,}", w)}
        out[i] = not any(own and x and len(own & x) / len(own | x) >= threshold for x in held)
        if out[i]:
            held.append(own)
    return out


def texts(kind, n, rng):
    words = [f"word{k}" for k in range(400)]
    fresh = lambda: " ".join(rng.sample(words, 12))
    if kind == "hot":
        hot = fresh()
        return [hot if rng.random() < 0.4 else rng.choice([fresh(), hot + " more", ""]) for _ in range(n)]
    if kind == "never forgets":  # a copy at every third place, others between
        hot = fresh()
        return [hot if k % 3 == 0 else f"other{k} thing{k} place{k}" for k in range(n)]
    pool = [fresh() for _ in range(n // 4)]
    return [rng.choice([rng.choice(pool), fresh(), None, "a b"]) for _ in range(n)]


@pytest.fixture
def many_chunks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("kind", ["hot", "never forgets", "pool"])
@pytest.mark.parametrize(("look_back", "at_once"), [(5, 3), (20, 1), (50, 2)])
def test_chunks_decide_like_one_pass(spark, many_chunks, monkeypatch, kind, look_back, at_once):
    monkeypatch.setattr(op, "ROUNDS_AT_ONCE", at_once)
    rows = list(enumerate(texts(kind, 500, random.Random(look_back))))
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    found = {r.id: r.kept for r in op.near_greedy(df, "id", F.col("t"), 0.9, look_back).collect()}
    assert found == plain(rows, 0.9, look_back) and not all(found.values())


def test_edge_rows(spark):
    df = spark.createDataFrame([(None, "one two three four"), (None, None), (3, ""), (3, "one two three four"), (4, "one two three four")], "id long, t string")
    found = op.near_greedy(df, "id", F.col("t"))
    assert sum(r.kept for r in found.collect()) == 3 and found.count() == 5
    assert op.near_greedy(df.limit(0), "id", F.col("t")).count() == 0
