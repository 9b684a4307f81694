"""Quality classifier: supervised subword embeddings.

Words, pairs of neighbouring words and character n-grams are hashed to buckets, each with a learned
vector; a document is the average of its buckets' vectors, followed by a softmax layer. Training is numpy
stochastic gradient descent over a bounded sample of labelled rows. The layer being linear, scoring needs
one number a bucket: the margin its vector adds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.common import map_batches, release_memory, staged, text_or_empty
from textloom.llm.wordbatch import SPACE, distinct, flat, ragged_take, regrouped, word_bounds

BUCKET_BITS = 17
GRAMS = (3, 4)
WIDTH, EPOCHS, RATE = 12, 8, 0.5
#: At most so many labelled documents, and so many bytes of their texts, are trained on, chosen by a hash of their ids.
TRAIN_DOCS, TRAIN_BYTES = 3000, 64 << 20
BATCH_BYTES = 2 << 20
SEED = 9
MIX = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MIX), -1, 1 << 64))


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket values, their offsets by word, a hash of each word): the word itself and its character n-grams within marks."""
    marked = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    start = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    places = len(marked)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(places, MIX, np.uint64)]))
    undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(places, INVERSE, np.uint64)]))
    prefix = np.zeros(places + 1, np.uint64)
    np.cumsum((marked + np.uint64(1)) * power[:-1], out=prefix[1:])
    span = lambda i, j: (prefix[j] - prefix[i]) * undo[i]  # noqa: E731  the same wherever the string stands
    whole = span(start[:-1], start[1:])
    owner, values = [np.arange(len(words))], [_bucket(whole)]
    word_of = np.repeat(np.arange(len(words)), size)
    for n in GRAMS:
        at = np.arange(len(marked))
        at = at[at + n <= start[1:][word_of]]
        owner.append(word_of[at])
        values.append(_bucket(span(at, at + n) + np.uint64(n)))
    owner, values = np.concatenate(owner), np.concatenate(values)
    order = np.argsort(owner, kind="stable")
    off = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(words)), out=off[1:])
    return values[order], off, whole


class Features:
    """The hashed features of a batch of texts: buckets by distinct word, and the buckets of neighbouring pairs."""

    def __init__(self, texts: pa.Array):
        raw, off = flat(texts)
        starts, ends = word_bounds(raw, off, ~SPACE[raw])
        self.codes, words = distinct(raw, starts, ends)
        self.values, self.off, word_hash = word_features([w.decode("utf-8", "replace") for w in words.to_pylist()])
        self.text_of = np.searchsorted(off, starts, "right") - 1
        self.n_texts = len(off) - 1
        together = self.text_of[1:] == self.text_of[:-1]
        left, right = self.codes[:-1][together], self.codes[1:][together]
        h = word_hash[left] * MIX + word_hash[right] + np.uint64(1)
        self.pairs = _bucket(np.where(left == right, np.uint64(1), h))  # a word after itself is one feature, whatever the word
        self.pair_text = self.text_of[1:][together]

    def margins(self, added: np.ndarray, bias: float) -> np.ndarray:
        """The average of ``added`` over each text's features, plus the bias; a text without words has the bias."""
        per_word = np.add.reduceat(added[self.values], self.off[:-1]) if len(self.values) else np.zeros(0)
        n_word = np.diff(self.off)
        total = np.bincount(self.text_of, per_word[self.codes], self.n_texts) + np.bincount(self.pair_text, added[self.pairs], self.n_texts)
        n = np.bincount(self.text_of, n_word[self.codes], self.n_texts) + np.bincount(self.pair_text, minlength=self.n_texts)
        return total / np.maximum(n, 1) + bias

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(buckets, counts) of each text."""
        word_at = np.searchsorted(self.text_of, np.arange(self.n_texts + 1))
        pair_at = np.searchsorted(self.pair_text, np.arange(self.n_texts + 1))
        for k in range(self.n_texts):
            own, _ = ragged_take(self.values, self.off, self.codes[word_at[k] : word_at[k + 1]])
            yield np.unique(np.concatenate([own, self.pairs[pair_at[k] : pair_at[k + 1]]]), return_counts=True)


def packed(at: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending buckets and their counts, small enough to be held for thousands of texts."""
    return zlib.compress(np.diff(at, prepend=0).astype("<i4").tobytes(), 1), zlib.compress(n.astype("<i4").tobytes(), 1)


def unpacked(at: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(zlib.decompress(at), "<i4")), np.frombuffer(zlib.decompress(n), "<i4")


def train(samples: list[tuple], width: int = WIDTH, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED, read=unpacked) -> tuple[np.ndarray, float]:
    """(margin by bucket, bias) from (buckets, counts, label 0 or 1), the first two packed. Without both labels every margin is 0."""
    labels = np.array([s[2] for s in samples], np.int64)
    if len(set(labels.tolist())) < 2:
        return np.zeros(1 << BUCKET_BITS, np.float32), (0.0 if not len(labels) else float(2 * labels[0] - 1))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / width, 1 / width, (1 << BUCKET_BITS, width)).astype(np.float32)
    layer, bias = np.zeros((width, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for k in random.permutation(len(samples)):
            at, n = read(*samples[k][:2])
            share = (n / max(1, n.sum())).astype(np.float32)
            pace = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[at]
            odds = hidden @ layer + bias
            odds = np.exp(odds - odds.max())
            wrong = odds / odds.sum()
            wrong[labels[k]] -= 1
            back = layer @ wrong
            layer -= pace * np.outer(hidden, wrong)
            bias -= pace * 0.1 * wrong
            # counts of a text add up to one, so a feature's step is taken for its share of the text
            vectors[at] -= (pace * len(at) ** 0.5 * share)[:, None] * back
    side = layer[:, 1] - layer[:, 0]
    return (vectors @ side).astype(np.float32), float(bias[1] - bias[0])


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3))


class QualityModel:
    def __init__(self, added: np.ndarray, bias: float):
        self.added, self.bias = added, bias

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out: int = 1, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> QualityModel:
        """Trains on at most train_docs labelled ids outside fold ``held_out``; the labels of others are never read.

        Of several labels of an id the smallest counts, and of several texts; null labels and ids don't.
        Texts are taken in the order of a hash of their ids until they have train_bytes; a text of more
        than half of that is passed over, so that it can't take the room of all others. What the driver
        holds is bounded by both. Without labels, or with labels of one kind, the model has a bias alone.
        """
        usable = labels.where((fold(id_col) != held_out) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        chosen = usable.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
        chosen = staged(chosen, "quality-labels")
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
        texts = staged(texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "quality-texts").where(F.octet_length("text") <= train_bytes // 2)
        so_far = F.sum(F.octet_length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # train_docs numbers
        texts = texts.join(F.broadcast(texts.select("doc_id", so_far.alias("so_far")).where(F.col("so_far") <= train_bytes).select("doc_id")), "doc_id")

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in regrouped(batches, "text", BATCH_BYTES):
                found = [packed(at, n) for at, n in Features(batch.column("text")).rows()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("label"), pa.array([at for at, _ in found], pa.binary()), pa.array([n for _, n in found], pa.binary())],
                    names=["doc_id", "label", "at", "n"],
                )

        rows = map_batches(texts, features, "doc_id long, label int, at binary, n binary").toArrow().sort_by("doc_id")
        samples = list(zip(*[rows.column(c).to_pylist() for c in ("at", "n", "label")], strict=True))
        try:
            return cls(*train(samples))
        finally:
            del samples, rows
            release_memory()

    def score(self, docs: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """docs with the probability of label 1, in place of a column of that name.

        Null and empty texts have that of the bias alone; repeated rows score alike; an empty table stays
        empty; nothing is shuffled.
        """
        added, bias = self.added, self.bias
        docs = docs.drop(score_col)
        schema = docs.select("*", F.lit(0.0).alias(score_col)).schema

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in regrouped(batches, text_col, BATCH_BYTES):
                margins = Features(batch.column(text_col)).margins(added, bias)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(margins, -50, 50))))], names=[*batch.schema.names, score_col])

        return map_batches(docs, score, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null and empty texts have the score of the bias alone; repeated rows score alike; an empty table gives no
    rows; a score of exactly 0.5 is predicted as 1; null ids are in the fold of the empty text. See QualityModel.
    """
    model = QualityModel.fit(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    scored = model.score(rows).drop("text")
    return scored.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """docs whose score is ``least`` or more, with their own columns."""
    name = "__quality_score"
    return model.score(docs, text_col, name).where(F.col(name) >= least).select(*docs.columns)
