"""Removal of repeated byte strings by suffix arrays over shards.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else in the corpus too. Every window
of that length chooses its anchor: its leftmost GRAM-byte string of the least hash. Equal windows choose
equal anchors, so they meet in the shard of the anchor's hash. The windows of one anchor are a segment of
less than two lengths. Segments that are equal as a whole are counted without being looked into; where an
anchor has different segments, a shard's suffix array (induced sorting) and its permuted common prefixes
tell which windows recur. An anchor with more segments than CROWD has its windows counted by hash instead,
so that no group has to fit into a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import map_batches, staged, text_or_empty
from textloom.llm.induced_sorting import permuted_common_prefixes, suffix_array
from textloom.llm.wordbatch import flat, regrouped

LENGTH, GRAM = 400, 32
CROWD = 4000
SHARD_BYTES = 1 << 20
BATCH_BYTES = 2 << 20
BROADCAST_KEYS = 1 << 21
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SEPARATOR, ALPHABET = 1, 258
#: Low bits of a rank that hold the place within a block of windows; a block and a window's reach fit into them.
RANK_BITS, RANK_BLOCK = np.uint64(26), 1 << 25


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of any stretch of bytes from prefix sums; equal stretches hash alike wherever they stand."""

    def __init__(self, raw: np.ndarray, base: np.uint64):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(raw), base, np.uint64)]))
        self.undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(raw), np.uint64(pow(int(base), -1, 1 << 64)), np.uint64)]))
        self.prefix = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.prefix[end] - self.prefix[start]) * self.undo[start])


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    many = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:many], forward[width - 1 : width - 1 + many])


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least value of each run of ``width``, by the high bits of values.

    The hash bits that count are the same for every batch, so equal runs always choose alike.
    """
    many, out = len(values) - width + 1, []
    for k in range(0, many, RANK_BLOCK):
        part = values[k : min(k + RANK_BLOCK, many) + width - 1]
        ranked = (part >> RANK_BITS << RANK_BITS) | np.arange(len(part), dtype=np.uint64)
        out.append((_window_minimum(ranked, width) & ((np.uint64(1) << RANK_BITS) - np.uint64(1))).astype(np.int64) + k)
    return np.concatenate(out)


def anchored_segments(raw: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, first, last, anchor hash, two segment hashes): windows first..last choose the anchor."""
    if len(raw) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(3))
    a, b = Rolling(raw, MIX_A), Rolling(raw, MIX_B)
    at = np.arange(len(raw) - gram + 1)
    grams = a(at, at + gram)
    del at
    best = _leftmost_least(grams, length - gram + 1)
    window = np.flatnonzero(np.diff(off) >= length)
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[off[:-1][window]] += 1
    np.subtract.at(inside, off[1:][window] - length + 1, 1)
    starts = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8)[: len(best)])
    anchor = best[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    # a run may also pass from one text to the next without a gap only where texts are shorter than the anchor's reach: never
    first = starts[fresh]
    last = starts[np.append(np.flatnonzero(fresh)[1:] - 1, len(starts) - 1)] if len(starts) else first
    anchor = anchor[fresh]
    shape = _mixed(((anchor - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64))
    return (np.searchsorted(off, first, "right") - 1, anchor, first, last, grams[anchor], a(first, last + length) ^ shape, b(first, last + length) + shape)


SEGMENT_SQL = "key binary, anchor_hash long, h1 long, h2 long, before int, after int, anchors array<int>"


def _segments(rows: DataFrame, length: int, gram: int, batch_bytes: int) -> DataFrame:
    """A row for each distinct segment of a text: its anchors' places, and how far its windows start before and end after them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text", batch_bytes):
            raw, off = flat(batch.column("text"))
            text, anchor, first, last, grams, h1, h2 = anchored_segments(raw, off, length, gram)
            order = np.lexsort((anchor, h2, h1, text))
            text, anchor, first, last, grams, h1, h2 = (x[order] for x in (text, anchor, first, last, grams, h1, h2))
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            heads = np.flatnonzero(new)
            signed = lambda x: pa.array(x[heads].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(text[heads])), signed(grams), signed(h1), signed(h2),
                    pa.array((anchor - first)[heads].astype(np.int32)), pa.array((last - anchor)[heads].astype(np.int32)),
                    pa.ListArray.from_arrays(np.append(heads, len(text)).astype(np.int32), pa.array((anchor - off[text]).astype(np.int32))),
                ],
                names=["key", "anchor_hash", "h1", "h2", "before", "after", "anchors"],
            )

    return map_batches(rows.where(F.octet_length("text") >= length).select("key", "text"), find, SEGMENT_SQL)


def recurring_windows(segments: list[tuple[bytes, int]], length: int) -> list[np.ndarray]:
    """For each (bytes, number of windows): which of its windows occur among those of the others.

    Each window of a segment stands at its start, in order; the bytes after the last one complete it.
    """
    pieces, own, base = [], [], 0
    for data, n in segments:
        pieces += [np.frombuffer(data, np.uint8).astype(np.int64) + 2, np.array([SEPARATOR])]
        own.append(base + np.arange(n))
        base += len(data) + 1
    text = np.concatenate([*pieces, [0]])
    order = suffix_array(text, ALPHABET)
    shared = permuted_common_prefixes(text, order)
    group = np.cumsum(shared[order] < length)
    is_own = np.zeros(len(text), bool)
    is_own[np.concatenate(own)] = True
    members = np.bincount(group[is_own[order]], minlength=int(group[-1]) + 1)
    recurs = np.zeros(len(text), bool)
    recurs[order] = members[group] > 1
    return [recurs[x] for x in own]


def _intervals(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


MARK_SQL = "anchor_hash long, h1 long, h2 long, low int, high int"
MARK = pa.schema([("anchor_hash", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])


def _marks_by_suffix_array(pieces: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """low..high, relative to the anchor: starts of windows of a segment that recur in other segments of the anchor.

    A partition is read in order of anchor and cut into shards of about shard_bytes between anchors.
    """

    def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(rows: list[dict]) -> pa.RecordBatch:
            flags = recurring_windows([(r["data"], r["before"] + r["after"] + 1) for r in rows], length)
            return pa.RecordBatch.from_pylist([{"anchor_hash": r["anchor_hash"], "h1": r["h1"], "h2": r["h2"], "low": x - r["before"], "high": y - r["before"]} for r, f in zip(rows, flags, strict=True) for x, y in _intervals(f)], schema=MARK)

        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= shard_bytes and row["anchor_hash"] != held[-1]["anchor_hash"]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["data"])
        if held:
            yield solve(held)

    return map_batches(pieces.repartition("anchor_hash").sortWithinPartitions("anchor_hash"), sort_shards, MARK_SQL)


def _marks_by_hash(pieces: DataFrame, length: int) -> DataFrame:
    """The same for the segments of crowded anchors, by counts of window hashes: rows of a group meet as partial counts only."""

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                raw = np.frombuffer(r["data"], np.uint8)
                at = np.arange(r["before"] + r["after"] + 1)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.full(n, r[c], np.int64)) for c in ("anchor_hash", "h1", "h2")], pa.array((at - r["before"]).astype(np.int32)), pa.array(Rolling(raw, MIX_A)(at, at + length).view(np.int64)), pa.array(Rolling(raw, MIX_B)(at, at + length).view(np.int64))],
                    names=["anchor_hash", "h1", "h2", "low", "w1", "w2"],
                )

    windows = staged(map_batches(pieces, hash_windows, "anchor_hash long, h1 long, h2 long, low int, w1 long, w2 long"), "crowded-windows")
    group = ["anchor_hash", "low", "w1", "w2"]
    repeated = windows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return windows.join(staged(repeated, "repeated-windows"), group, "left_semi").select("anchor_hash", "h1", "h2", "low", F.col("low").alias("high"))


def _limited(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """rows whose key is among distinct keys; these are broadcast if they are few enough."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, "key", "left_semi")


def _pieces(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted segments (key, anchor, before, after and hashes)."""
    by_text = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "before", "after", "anchor_hash", "h1", "h2")).alias("segments"))
    texts = _limited(rows.select("key", "text"), wanted.select("key").distinct()).dropDuplicates(["key"]).join(by_text, "key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text", BATCH_BYTES):
            raw, off = flat(batch.column("text"))
            raw = raw.tobytes()
            found = [
                {**{c: s[c] for c in ("anchor_hash", "h1", "h2", "before", "after")}, "data": raw[start + s["anchor"] - s["before"] : start + s["anchor"] + s["after"] + length]}
                for start, segments in zip(off.tolist(), batch.column("segments").to_pylist(), strict=False)
                for s in segments
            ]
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema([("anchor_hash", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("data", pa.binary())]))

    return map_batches(texts, cut, "anchor_hash long, h1 long, h2 long, before int, after int, data binary")


def repeated_spans(rows: DataFrame, length: int, gram: int, crowd: int, shard_bytes: int, batch_bytes: int) -> DataFrame:
    """key, spans (array of begin and end, apart from each other), for texts with repeated strings. rows: key, text."""
    segments = staged(_segments(rows, length, gram, batch_bytes), "segments")
    same = ["anchor_hash", "h1", "h2", "before", "after"]
    kinds = segments.groupBy(*same).agg(F.sum(F.size("anchors")).alias("n"), F.min(F.struct("key", F.col("anchors")[0].alias("anchor"))).alias("one"))
    kinds = staged(kinds, "segment-kinds")
    whole = kinds.where("n > 1").select("anchor_hash", "h1", "h2", (-F.col("before")).alias("low"), F.col("after").alias("high"))
    crowds = staged(kinds.groupBy("anchor_hash").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1"), "anchors-of-several")
    several = staged(kinds.join(crowds, "anchor_hash").select(*same, "crowd", "one.key", "one.anchor"), "different-segments")
    pieces = staged(_pieces(rows, several.drop("crowd"), length).join(crowds, "anchor_hash"), "segment-bytes")
    marks = whole.unionByName(_marks_by_suffix_array(pieces.where(F.col("crowd") <= crowd).drop("crowd"), length, shard_bytes)).unionByName(_marks_by_hash(pieces.where(F.col("crowd") > crowd).drop("crowd"), length))
    marks = staged(marks, "marks")
    hit = segments.select("key", "anchor_hash", "h1", "h2", "anchors").join(marks, ["anchor_hash", "h1", "h2"])
    spans = hit.select("key", F.explode("anchors").alias("anchor"), "low", "high").groupBy("key").agg(F.collect_set(F.struct((F.col("anchor") + F.col("low")).alias("begin"), (F.col("anchor") + F.col("high") + length).alias("end"))).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch.column("spans").to_pylist():
                merged: list[list[int]] = []
                for begin, end in sorted((s["begin"], s["end"]) for s in spans):
                    if merged and begin <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([begin, end])
                out.append(merged)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.list_(pa.list_(pa.int32())))], names=["key", "spans"])

    return map_batches(spans, merge, "key binary, spans array<array<int>>")


def _characters(data: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, shard_bytes: int = SHARD_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), kept_sha256, n_chars.

    Texts are UTF-8 bytes; matches don't cross rows. Null counts as empty; a text shorter than ``length``
    stays whole. Repeated rows repeat each other, so that rows of an equal, long enough text lose all of
    it. An empty table gives no rows; other columns are not read; ids are passed on as they are. Texts are
    told apart by their MD5, strings by 128 bits of hash where no suffix array compares them. n_bytes is of
    the whole text; n_chars counts the characters that begin in what is left. ``kept`` is null where
    everything or nothing is removed. The spans of a text, some bytes for each two hundred of it at most,
    are together in one row, as the text is.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("key", F.unhex(F.md5("text")))
    spans = staged(repeated_spans(rows, length, gram, crowd, shard_bytes, batch_bytes), "repeated-spans")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    spans = spans.select("key", "spans", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"))
    digests = staged(rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.char_length("text").cast("long").alias("chars")), "text-digests")
    counted = staged(digests.join(spans.drop("spans"), "key", "left"), "removed-counts")
    partial = counted.where((F.col("n_removed") > 0) & (F.col("n_removed") < F.col("n_bytes")))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text", BATCH_BYTES):
            kept = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw, at, parts = text.encode("utf-8", "surrogatepass"), 0, []
                for begin, end in spans:
                    parts.append(raw[at:begin])
                    at = end
                kept.append(b"".join([*parts, raw[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array([_characters(x) for x in kept], pa.int64())], names=["key", "kept", "kept_sha256", "n_chars"])

    touched = staged(partial.select("key").distinct(), "touched-texts")
    texts = _limited(rows.select("key", "text"), touched).dropDuplicates(["key"]).join(spans.select("key", "spans"), "key")
    cut = map_batches(texts, keep, "key binary, kept binary, kept_sha256 string, n_chars long")
    nothing = F.when(F.col("n_removed").isNull(), F.col("sha256")).otherwise(F.sha2(F.lit("").cast("binary"), 256))
    known = counted.where(~((F.col("n_removed") > 0) & (F.col("n_removed") < F.col("n_bytes"))) | F.col("n_removed").isNull())
    columns = ["doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), "kept", "kept_sha256", "n_chars"]
    known = known.withColumns({"kept": F.lit(None).cast("binary"), "kept_sha256": nothing, "n_chars": F.when(F.col("n_removed").isNull(), F.col("chars")).otherwise(0)})
    return known.select(*columns).unionByName(partial.join(cut, "key").select(*columns))
