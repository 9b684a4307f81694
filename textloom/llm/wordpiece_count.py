"""Word-piece token counts by a linear longest-match automaton.

The vocabulary's trie gets a failure link and a count of popped pieces at each node: where no edge fits,
the pieces matched so far are popped and matching goes on at the linked node. Every byte is read once and
no piece is built. All distinct words of a batch step through the automaton together.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import map_batches, text_or_empty
from textloom.llm.wordbatch import SPACE, binary_parts, distinct, flat, regrouped, word_bounds

NONE = -1
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
BATCH_BYTES = 8 << 20


def pieces_of_byte_bpe(path: str, marker: str = "Ġ") -> tuple[set[bytes], set[bytes]]:
    """(word-initial pieces, continuing pieces) of a byte-level vocabulary file whose marker opens a word.

    The file spells bytes as printable characters: printable Latin-1 stands for itself, the rest is
    numbered upwards from U+0100.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    first, later = set(), set()
    for token in json.load(open(path, encoding="utf-8"))["model"]["vocab"]:
        body = token[len(marker) :] if token.startswith(marker) else token
        if body and all(c in spelled for c in body):
            (first if body is not token else later).add(bytes(spelled[c] for c in body))
    return first, later


class LongestMatch:
    """The automaton. ``counts`` gives pieces per word, with 0 for a word that the vocabulary can't spell."""

    def __init__(self, first: set[bytes], later: set[bytes]):
        edges: list[dict[int, int]] = [{}, {}]  # node 0: start of a word; node 1: start of a continuing piece
        is_piece, parent, order = [False, False], [NONE, NONE], []
        for root, pieces in ((0, first), (1, later)):
            for piece in pieces:
                at = root
                for b in piece:
                    nxt = edges[at].get(b)
                    if nxt is None:
                        nxt = edges[at][b] = len(edges)
                        edges.append({})
                        is_piece.append(False)
                        parent.append(at)
                    at = nxt
                is_piece[at] = is_piece[at] or at > 1
        link, popped = [NONE] * len(edges), [0] * len(edges)
        level = [0, 1]
        while level:
            order = [(node, b, child) for node in level for b, child in edges[node].items()]
            for node, b, child in order:
                if is_piece[child]:
                    link[child], popped[child] = 1, 1
                    continue
                z, pops = link[node], popped[node]
                while z != NONE and b not in edges[z]:
                    pops += popped[z]
                    z = link[z]
                if z != NONE:
                    link[child], popped[child] = edges[z][b], pops
            level = [child for _, _, child in order]
        end = [NONE] * len(edges)  # pieces popped from a node at the end of a word
        for node in range(2, len(edges)):
            z, pops = node, 0
            while z not in (NONE, 1):
                pops += popped[z]
                z = link[z]
            end[node] = NONE if z == NONE else pops
        pairs = sorted((node * 256 + b, child) for node, out in enumerate(edges) for b, child in out.items())
        self.keys = np.array([k for k, _ in pairs], np.int64)
        self.children = np.array([c for _, c in pairs], np.int32)
        self.link, self.popped, self.end = np.array(link, np.int32), np.array(popped, np.int32), np.array(end, np.int32)

    def counts(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        lengths = off[1:] - off[:-1]
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = off[:-1][order], lengths[order]
        state, total = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        longest = int(lengths[0]) if len(order) else 0
        alive = np.searchsorted(-lengths, -np.arange(longest), "left")  # words longer than each step
        for step in range(longest):
            left = np.arange(alive[step])
            left = left[state[left] != NONE]
            byte = raw[starts[left] + step].astype(np.int64)
            while len(left):
                key = state[left].astype(np.int64) * 256 + byte
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                state[left[hit]] = self.children[at[hit]]
                left, byte = left[~hit], byte[~hit]
                total[left] += self.popped[state[left]]
                state[left] = self.link[state[left]]
                going = state[left] != NONE
                left, byte = left[going], byte[going]
        tail = np.where(state == NONE, NONE, self.end[state])
        out = np.zeros(len(order), np.int64)
        out[order] = np.where(tail == NONE, 0, total + tail)
        return out


def wordpiece_counts(docs: DataFrame, first: set[bytes], later: set[bytes], id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_tokens, n_unknown.

    Words are runs of bytes other than ASCII white space, with every ASCII punctuation mark a word of its
    own. n_tokens counts greedy longest-match pieces; a word that can't be spelled counts as one token and
    in n_unknown. Null and empty texts count 0. Ids are passed on as they are, nulls and repeats too.
    Nothing is shuffled; a batch holds about ``batch_bytes`` of text, or one longer text.
    """
    automaton = LongestMatch(first, later) if first or later else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text", batch_bytes):
            raw, off = flat(batch.column("text"))
            starts, ends = word_bounds(raw, off, ~SPACE[raw], PUNCTUATION[raw])
            codes, words = distinct(raw, starts, ends)
            per_word = automaton.counts(*binary_parts(words)) if automaton and len(words) else np.zeros(len(words), np.int64)
            unknown = per_word == 0
            text_of = np.searchsorted(off, starts, "right") - 1
            sums = [np.bincount(text_of, weights=w, minlength=len(off) - 1).astype(np.int64) for w in (np.ones(len(codes)), np.where(unknown, 1, per_word)[codes], unknown[codes])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, sums)], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_batches(rows, count, "doc_id long, n_words long, n_tokens long, n_unknown long")
