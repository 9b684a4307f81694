import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge_rows import ROWS
from pyspark.sql import functions as F

from textloom.llm import quality as op


def corpus(n=400):
    random.seed(2)
    good = "the river runs slowly past old mills and quiet gardens".split()
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        words = [random.choice(good) for _ in range(60)]
        text = " ".join(w.upper() + "!!" if bad else w for w in words)
        rows.append((i, text))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_learns_and_holds_out(spark, docs_of):
    rows, labels = corpus()
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in op.quality_scores(docs_of(rows), labels).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [i for i in got if got[i].held_out]
    assert np.mean([got[i].predicted == (i % 3 != 0) for i in held]) > 0.97
    # labels of the held-out fold change nothing
    flipped = labels.withColumn("quality", F.when(op.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in op.quality_scores(docs_of(rows), flipped).collect()}
    assert again == pytest.approx({i: r.score for i, r in got.items()})


def test_features_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = ["alpha beta beta", "gamma", "", "ünï code"]
    whole = list(op.Features(pa.array(texts)).rows())
    for k, text in enumerate(texts):
        alone = next(op.Features(pa.array([text])).rows())
        assert alone[0].tolist() == whole[k][0].tolist() and alone[1].tolist() == whole[k][1].tolist()


def test_edge_tables(spark, edge, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, 0), (2, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        assert op.quality_scores(edge, labels).count() == len(ROWS)
    assert op.quality_scores(nothing, odd).count() == 0
    kept = op.keep_good(edge, op.QualityModel.fit(edge, none))
    assert kept.columns == edge.columns


def plain_features(text):
    """Buckets of one text, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    with np.errstate(over="ignore"):
        out, hashes = [], []
        for w in words:
            values, _, h = op.word_features([w])
            assert len(values) == 1 + sum(max(0, len(w) + 2 - n + 1) for n in op.GRAMS)
            out += values.tolist()
            hashes.append(h)
        for a, b in zip(range(len(words)), range(1, len(words)), strict=False):
            own = np.array([1], np.uint64) if words[a] == words[b] else hashes[a] * op.MIX + hashes[b] + np.uint64(1)
            out += op._bucket(own).tolist()
    return out


def test_margins_and_rows_against_plain_loops():
    texts = ["one two two three", "", "naïve 漢字 😀 x", "one " * 30, "\t\n", "alpha beta gamma alpha beta"]
    features = op.Features(pa.array(texts))
    added = np.random.default_rng(1).normal(size=1 << op.BUCKET_BITS).astype(np.float32)
    margins = features.margins(added, 0.25)
    for text, margin, (at, n) in zip(texts, margins, features.rows(), strict=True):
        own = plain_features(text)
        assert margin == pytest.approx(0.25 + (float(np.mean(added[own])) if own else 0.0), abs=1e-5)
        assert dict(zip(at.tolist(), n.tolist(), strict=True)) == dict(Counter(own))


def test_training_against_plain_loops():
    samples = [(np.array([3, 5, 9]), np.array([1, 2, 1]), 1), (np.array([5, 8]), np.array([3, 1]), 0), (np.array([2]), np.array([1]), 1)]
    width, epochs, rate = 4, 3, 0.5
    got, bias = op.train([(*op.packed(at, n), label) for at, n, label in samples], width, epochs, rate, seed=7)
    draw = np.random.default_rng(7)
    vectors = draw.uniform(-1 / width, 1 / width, (1 << op.BUCKET_BITS, width)).astype(np.float32).tolist()
    layer, base, done = [[0.0, 0.0] for _ in range(width)], [0.0, 0.0], 0
    for _ in range(epochs):
        for k in draw.permutation(len(samples)).tolist():
            at, n, label = samples[k]
            share = [c / sum(n.tolist()) for c in n.tolist()]
            pace = rate * (1 - done / (epochs * len(samples)))
            done += 1
            hidden = [sum(s * vectors[a][j] for s, a in zip(share, at.tolist(), strict=True)) for j in range(width)]
            odds = [math.exp(sum(hidden[j] * layer[j][c] for j in range(width)) + base[c]) for c in (0, 1)]
            wrong = [odds[c] / sum(odds) - (c == label) for c in (0, 1)]
            back = [sum(layer[j][c] * wrong[c] for c in (0, 1)) for j in range(width)]
            for c in (0, 1):
                base[c] -= pace * 0.1 * wrong[c]
                for j in range(width):
                    layer[j][c] -= pace * hidden[j] * wrong[c]
            for s, a in zip(share, at.tolist(), strict=True):
                for j in range(width):
                    vectors[a][j] -= pace * math.sqrt(len(at)) * s * back[j]
    for a in (2, 3, 5, 8, 9):
        assert got[a] == pytest.approx(sum(vectors[a][j] * (layer[j][1] - layer[j][0]) for j in range(width)), rel=1e-3, abs=1e-5)
    assert bias == pytest.approx(base[1] - base[0], rel=1e-3)


def test_repeated_ids_and_bytes_bound_the_sample(spark, docs_of, monkeypatch):
    seen = []
    monkeypatch.setattr(op, "train", lambda samples: seen.append(samples) or (np.zeros(1 << op.BUCKET_BITS, np.float32), 0.0))
    docs = docs_of([(i % 20, f"text {i} " * 10) for i in range(200)] + [(None, "x")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    op.QualityModel.fit(docs, labels)
    assert 0 < len(seen[-1]) <= 20
    op.QualityModel.fit(docs, labels, train_bytes=250)
    assert 0 < len(seen[-1]) <= 3
    op.QualityModel.fit(docs, labels.where("false"))
    assert seen[-1] == []


def test_a_text_over_the_bound_does_not_untrain(spark, docs_of):
    docs = docs_of([(i, ("good words here " if i % 2 else "bad stuff there ") * (4000 if i < 12 else 1)) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    model = op.QualityModel.fit(docs, labels, train_bytes=1200)  # a dozen texts have 64 kB
    assert np.count_nonzero(model.added)
    assert {r.doc_id for r in op.keep_good(docs, model).collect()} == set(range(1, 60, 2))
