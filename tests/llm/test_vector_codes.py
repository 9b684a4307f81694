import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import vector_codes as op

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, total int, vector int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", 1, 2) for i, v, label in rows], SCHEMA)


def brute(rows, parts, entries, rounds):
    """Plain loops over whole distances; vectors that take no part must be left out already."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(own[k]) for c in zip(*own[k], strict=True)] if k in own else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[near(cut(v, p), books[p]) for p in range(parts)] for _, v, _ in kept]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    long = lambda x: x if x < 1 << 63 else None
    return [(i, label, "".join(f"{k:02x}" for _, k in f), long(e), long(by_label[label]), digest) for (i, _, label), f, e in zip(kept, found, errors, strict=True)]


def got(df):
    return sorted((tuple(r[c] for c in ("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 16), st.sampled_from([1, 3, 8]), st.sampled_from([2, 50, 1 << 40]))
def test_search_is_exact_with_ties(seed, entries, width, spread):
    rng = random.Random(seed)
    some = lambda n: np.array([[rng.randrange(-spread, spread) for _ in range(width)] for _ in range(n)], object if spread > op.SMALL else np.int64)
    vectors, book = some(20), some(entries)
    code, best = op.nearest_entries(vectors, book)
    for k, v in enumerate(vectors.tolist()):
        assert (best[k], code[k]) == min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), j) for j, e in enumerate(book.tolist()))


def test_order_is_by_descending_variance():
    assert op.search_order(np.array([[0, 5, 1], [10, 5, -1], [0, 5, 3]])) == [0, 2, 1]


@pytest.mark.parametrize("case", ["few", "ties", "huge", "hot"])
def test_against_plain_loops(spark, case):
    rng = random.Random(5)
    value = {"few": lambda: rng.choice([-1.5, 0.25, 2.0]), "ties": lambda: float(rng.randrange(2)), "huge": lambda: rng.choice([3e38, -3e38, 1e20, 0.1, 5e4]), "hot": lambda: rng.uniform(-1, 1)}[case]
    n = {"few": 5, "ties": 60, "huge": 40, "hot": 200}[case]
    data = [(rng.choice([None, k, k - 7]) if case == "ties" else k, [float(np.float32(value())) for _ in range(16)], 7 if case == "hot" and k % 3 else rng.choice([None, 1, 2])) for k in range(n)]
    df = table_of(spark, data).repartition(3)
    assert got(op.compress_vectors(df)) == sorted(brute(data, 8, 16, 6), key=repr)
    assert got(op.compress_vectors(df, parts=4, entries=3, rounds=2)) == sorted(brute(data, 4, 3, 2), key=repr)


def test_rows_that_take_no_part(spark):
    good = [(k, [0.5 * k] * 8, None) for k in range(4)]
    bad = [(-1, None, 1), (-2, [], 1), (-3, [None] + [1.0] * 7, 1), (-4, [math.nan] * 8, 1), (-5, [math.inf] + [0.0] * 7, 1), (9, [1.0] * 16, 1)]
    assert got(op.compress_vectors(table_of(spark, good + bad))) == sorted(brute(good, 8, 16, 6), key=repr)
    assert op.compress_vectors(table_of(spark, bad[:5])).count() == 0 and op.compress_vectors(table_of(spark, [])).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        op.compress_vectors(table_of(spark, [(1, [1.0] * 9, 1)]))


def test_codes_decode_to_their_entries(spark):
    data = table_of(spark, [(k, [float(k % 5)] * 16, 1) for k in range(50)])
    kept = data.selectExpr("CAST(embedding AS array<double>) AS vector")
    books = op.fit_codebooks(kept, op.integers(np.array([[float(k)] * 16 for k in range(5)]).ravel()).reshape(5, 16), parts=4)
    assert op.decoded("03030303", books) == [3 * 4096] * 16
