import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from edge_rows import ROWS

from textloom.llm import induced_sorting as sort
from textloom.llm import suffix_dedup as op


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, texts, strict=True):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i is not None, i or 0, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def ours(docs, **options):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op.remove_repeats(docs, **options).collect())


@pytest.mark.parametrize("recurse", [0, 1024])
def test_suffix_arrays(monkeypatch, recurse):
    monkeypatch.setattr(sort, "RECURSE_ALPHABET", recurse)
    random.seed(1)
    for trial in range(200):
        letters = random.randint(1, 4)
        text = [random.randint(1, letters) for _ in range(random.randint(0, 60))]
        if trial % 4 == 0:
            text = text[:3] * 8
        text = np.array([*text, 0])
        plain = text.tolist()
        order = sort.suffix_array(text, 6)
        assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        shared = sort.permuted_common_prefixes(text, order)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
            n = 0
            while b + n < len(plain) and a + n < len(plain) and plain[a + n] == plain[b + n]:
                n += 1
            assert shared[b] == n


@pytest.mark.parametrize("crowd", [1, 2, 4000])
def test_random_texts(docs_of, crowd):
    random.seed(crowd)
    parts = ["".join(random.choice("ab c") for _ in range(random.randint(5, 40))) for _ in range(8)]
    rows = [(i, "".join(random.choice([*parts, f"<{random.random()}>", "é"]) for _ in range(random.randint(0, 12)))) for i in range(60)]
    rows += [(60, "ab" * 50), (61, "ab" * 50), (62, "z" * 70)]
    assert ours(docs_of(rows), length=20, gram=6, crowd=crowd, shard_bytes=300, batch_bytes=400) == brute(rows, 20)


def test_edge_rows(edge, nothing):
    rows = [r for r in ROWS if len(r[1] or "") < 100_000]
    assert ours(edge.where("n_chars < 100000"), length=30, gram=8) == brute(rows, 30)
    got = {r.doc_id: r for r in op.remove_repeats(edge).collect()}
    assert got[9].n_removed == got[9].n_bytes and got[10].n_bytes - got[10].n_removed == len(" tail")
    assert op.remove_repeats(nothing).count() == 0


def test_characters_left(docs_of):
    rows = [(1, "é" * 300 + "tail 漢字"), (2, "é" * 300 + " other"), (3, "alone ü"), (4, None)]
    got = {r.doc_id: r for r in op.remove_repeats(docs_of(rows), length=401).collect()}
    for i, text in rows:  # a cut may part a character: it counts where its first byte is left
        kept = bytes(got[i].kept) if got[i].kept is not None else (text or "").encode() if not got[i].n_removed else b""
        assert got[i].n_chars == sum(b & 0xC0 != 0x80 for b in kept) and len(kept) == got[i].n_bytes - got[i].n_removed
    assert got[3].n_chars == 7 and got[1].n_removed


def test_planted_passages(docs_of):
    random.seed(7)
    words = lambda n, k: " ".join("".join(random.choice("abcdefghij") for _ in range(k)) for _ in range(n))
    rows, long, short = [], [], []
    for _ in range(4):
        for group, letters in ((long, 9), (short, 6)):  # 51 words of 509 and of 356 bytes
            passage = words(51, letters)
            for _ in range(3):
                group.append((len(rows), len(passage)))
                rows.append((len(rows), f"{words(random.randint(5, 80), 6)} {passage} {words(random.randint(5, 80), 6)}"))
    rows += [(100 + i, words(random.randint(20, 200), 6)) for i in range(20)]
    assert ours(docs_of(rows)) == brute(rows, 400)
    got = {r.doc_id: r for r in op.remove_repeats(docs_of(rows)).collect()}
    assert all(n <= got[i].n_removed < n + 10 and got[i].n_chars == got[i].n_bytes - got[i].n_removed for i, n in long)
    alone = {i for i, _ in rows} - {i for i, _ in long}
    assert {i for i, _ in short} < alone and all(got[i].n_removed == 0 and got[i].n_chars == len(t) for i, t in rows if i in alone)


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 25])
def test_anchors_do_not_depend_on_the_batch(monkeypatch, block):
    monkeypatch.setattr(op, "RANK_BLOCK", block)
    values = np.random.default_rng(3).integers(0, 9, 200).astype(np.uint64) << op.RANK_BITS
    assert op._leftmost_least(values, 10).tolist() == [k + int(np.argmin(values[k : k + 10])) for k in range(191)]
