import random
import re

from edge_rows import ROWS

from textloom.llm import wordpiece_count as op


def longest_match(word, first, later):
    n = at = 0
    while at < len(word):
        pieces = later if at else first
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        n, at = n + 1, end
    return n


def words_of(text):
    return re.findall(rb"[!-/:-@\[-`{-~]|[^\x20\x09-\x0d!-/:-@\[-`{-~]+", (text or "").encode())


def check(docs, rows, first, later):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_tokens, r.n_unknown) for r in op.wordpiece_counts(docs, first, later, batch_bytes=2000).collect())
    want = []
    for i, text in rows:
        counts = [longest_match(w, first, later) for w in words_of(text)]
        want.append((i is not None, i or 0, len(counts), sum(max(1, c) for c in counts), counts.count(0)))
    assert got == sorted(want)


def test_edge_rows(edge):
    first = {b"al", b"alpha", b"o", b"one", b"w", b"a"}
    later = {bytes([b]) for b in range(97, 123)} | {b"pha", b"aa", b"aaa"}
    check(edge, ROWS, first, later)


def test_random_vocabularies():
    random.seed(5)
    for _ in range(300):
        piece = lambda: bytes(random.choice(b"ab") for _ in range(random.randint(1, 4)))
        first, later = {piece() for _ in range(4)}, {piece() for _ in range(4)}
        words = [bytes(random.choice(b"abc") for _ in range(random.randint(1, 9))) for _ in range(20)]
        import numpy as np

        off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        counts = op.LongestMatch(first, later).counts(np.frombuffer(b"".join(words), np.uint8), off)
        assert counts.tolist() == [longest_match(w, first, later) for w in words]


def test_no_vocabulary_and_no_rows(edge, nothing):
    assert all(r.n_tokens == r.n_unknown == r.n_words for r in op.wordpiece_counts(edge, set(), set()).collect())
    assert op.wordpiece_counts(nothing, {b"a"}, set()).count() == 0
