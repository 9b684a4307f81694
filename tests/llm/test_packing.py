import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from edge_rows import ROWS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textloom.llm import packing as op

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [op.END_ID]


def pieces_of(doc_id, text, capacity):
    ids = ids_of(text)
    n = -(-len(ids) // capacity)
    bounds = [0] + [len(ids) - capacity * k for k in range(n - 1, -1, -1)]
    return [(doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]


def key(row):
    return tuple((x is not None, x or 0) for x in row)


def check(got, rows, capacity):
    """Pieces as brute force has them, sequences without gaps; returns the number of sequences."""
    wanted = sorted((p for i, t in rows for p in pieces_of(i, t, capacity)), key=key)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == wanted
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abzAZ é'.,=!<>|09 \t\n\r\x1c\x00漢😀  　\u0085sdt½"), max_size=30), max_size=5))
def test_stretches_encode_like_whole_texts(texts):
    ids, off = op.encoder_of(PATH)(pa.array(texts, pa.string()), op.END_ID)
    for k, text in enumerate(texts):
        assert ids[off[k] : off[k + 1]].tolist() == ids_of(text)


def test_special_strings_and_full_memory(monkeypatch):
    monkeypatch.setattr(op, "KNOWN_WORDS", 3)
    encoder = op.ByteLevelEncoder(PATH)
    for texts in (["a <|endoftext|> b<|endoftext|>", " <|endoftext|>x.y's", None], ["I'm don'T", "one two three four five six one"], ["one two seven", ""]):
        ids, off = encoder(pa.array(texts, pa.string()), op.END_ID)
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [ids_of(t) for t in texts]
    assert len(encoder.known) == 3


def best_fit_one_by_one(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fitting = [x for x in free if x >= n]
        if fitting:
            free.remove(min(fitting))
            free.append(min(fitting) - n)
        else:
            free.append(capacity - n)
    return len(free)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.sampled_from([40, 64]))
def test_contents_use_every_piece_once(lengths, capacity):
    counts = np.bincount(lengths or [0], minlength=capacity + 1)
    counts[0] = 0
    for held in (None, 0, 7):
        contents = op.pack_lengths(counts, capacity) if held is None else op._exact_then_best_fit(counts, capacity, held)
        used = np.zeros(capacity + 1, np.int64)
        for content, times in contents:
            assert times > 0 and sum(n * k for n, k in content) <= capacity
            for n, k in content:
                used[n] += k * times
        assert np.array_equal(used, counts)
    assert sum(t for _, t in op._best_fit(counts, capacity)) == best_fit_one_by_one(lengths, capacity)


def test_exact_fills_waste_nothing():
    # singles, pairs and triples that fill exactly where longest-first best fit would not
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 50, 30, 20, 55, 45, 34, 33]] = [10**9, 10**9, 7, 7, 7, 3, 3, 5, 10]
    contents = op.pack_lengths(counts, 100)
    total = sum(t for _, t in contents)
    assert total == -(-int((counts * np.arange(101)).sum()) // 100)
    assert len(contents) < 20  # a thousand million pieces are no more work than ten


def test_combinations_follow_the_counts():
    counts = np.zeros(21, np.int64)
    counts[[5, 10]] = [3, 1]
    index = op.Combinations(counts)
    assert list(index.filling(10)) == [(10,), (5, 5)] and list(index.filling(15)) == [(10, 5), (5, 5, 5)] and list(index.filling(0)) == [()]
    index.take((10, 5), 1)
    assert list(index.filling(15)) == [(5, 5, 5)] and index.often((5, 5, 5)) == 0 and index.often((5, 5)) == 1


@pytest.mark.parametrize("capacity", [16, 1024])
def test_edge_rows(edge, capacity):
    n = check(op.pack_documents(edge, PATH, capacity=capacity, batch_bytes=1000).collect(), ROWS, capacity)
    tokens = sum(len(ids_of(t)) for _, t in ROWS)
    assert -(-tokens // capacity) <= n <= -(-tokens // capacity) + 2


def test_hot_lengths_over_many_tasks(docs_of):
    rows = [(i, "same words here") if i % 3 else (i, f"word{i} " * (i % 40)) for i in range(900)]
    got = op.pack_documents(docs_of(rows).repartition(7), PATH, capacity=64).collect()
    lengths = [p[3] for i, t in rows for p in pieces_of(i, t, 64)]
    assert check(got, rows, 64) <= best_fit_one_by_one(lengths, 64)


def test_sequences_hold_their_ids(edge):
    for r in op.packed_sequences(edge, PATH, capacity=256).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.n_tokens == sum(r.lengths) <= 256 and len(r.doc_ids) == len(r.lengths)
        if len(r.lengths) == 1 and r.doc_ids[0] == 8:
            assert ids.tolist() == ids_of(dict(ROWS)[8])


def test_query(spark):
    from textloom.llm.registry import op11_packing

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    lengths = [p[3] for i, t in rows for p in pieces_of(i, t, 1024)]
    assert check(op11_packing(spark, folder).collect(), rows, 1024) <= best_fit_one_by_one(lengths, 1024)


def test_empty_table(nothing):
    assert op.pack_documents(nothing, PATH).count() == 0 and op.packed_sequences(nothing, PATH).count() == 0
