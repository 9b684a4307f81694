"""SentencePiece encoding by a batched numpy Viterbi search, and its decoding.

The model file gives pieces and scores; the best segmentation is the one of the largest score sum. No
piece holds a space after another character, so a text falls apart into units that are searched alone,
each distinct unit once a batch. Hashes of growing substrings probe the sorted hashes of piece prefixes;
units of equal length then advance together, the maxima of a step storing the back-pointers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import map_batches, text_or_empty
from textloom.llm.wordbatch import binary_parts, distinct, flat, ragged_take, regrouped

META = b"\xe2\x96\x81"  # how a model file spells a space
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Below the worst piece by so much is a character that has no piece of its own (fixed value of the format).
UNKNOWN_PENALTY = 10.0
BATCH_BYTES = 2 << 20
LONG_UNIT = 2048


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a serialised protocol-buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        yield tag >> 3, value


def read_pieces(path: str) -> list[tuple[bytes, float, int]]:
    """(piece, score, type) of a .model file in id order; type 1 is normal, 6 a byte."""
    pieces = []
    for number, value in _fields(open(path, "rb").read()):
        if number == 1:
            own = dict(_fields(value))
            pieces.append((own.get(1, b""), float(np.frombuffer(own.get(2, bytes(4)), "<f4")[0]), own.get(3, 1)))
    return pieces


class PieceModel:
    """Piece tables for encoding and decoding.

    Scores are summed as the unigram search does, whatever search the file was made for. Text is taken as
    it is, without Unicode normalisation, after one space is put before it; a literal U+2581 is spelled in
    bytes, so that decoding gives back every text exactly.
    """

    def __init__(self, pieces: list[tuple[bytes, float, int]]):
        normal = {p.replace(META, b" "): (i, s) for i, (p, s, kind) in enumerate(pieces) if kind == 1}
        self.byte_ids = np.full(256, -1, np.int64)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == 6:
                self.byte_ids[int(p[3:5], 16)] = i
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        if any(b" " in p.lstrip(b" ") for p in normal):
            raise ValueError("a piece goes on after a space")
        self.unknown = min((s for _, s in normal.values()), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, normal), default=0)
        prefixes: dict[int, int] = {}
        scores = []
        for p, (i, s) in normal.items():
            h = 0
            for n, b in enumerate(p, 1):
                h = (h * int(MULTIPLIER) + b + 1) & (2**64 - 1)
                prefixes.setdefault(h, -1)
                if n == len(p):
                    if prefixes[h] >= 0:
                        raise ValueError("two pieces share a hash")
                    prefixes[h] = i
            scores.append((i, s))
        self.keys = np.array(sorted(prefixes), np.uint64)
        self.piece_at = np.array([prefixes[int(k)] for k in self.keys.tolist()], np.int64)
        self.scores = np.full(len(pieces), -np.inf)
        for i, s in scores:
            self.scores[i] = s
        # bytes of ASCII that stand in no piece part units like white space does
        used = np.zeros(256, bool)
        for p in normal:
            used[list(p)] = True
        self.cuts = ~used
        self.cuts[128:] = False
        spelled = [bytes([int(p[3:5], 16)]) if kind == 6 else p.replace(META, b" ") if kind == 1 else b"" for p, _, kind in pieces]
        self.bytes_off = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum([len(x) for x in spelled], out=self.bytes_off[1:])
        self.bytes_flat = np.frombuffer(b"".join(spelled), np.uint8)

    def unit_starts(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where units begin: at texts, at the first of some spaces, at and after bytes that no piece has."""
        space = raw == 0x20
        first = space.copy()
        first[1:] &= ~space[:-1]
        cut = self.cuts[raw]
        first |= cut
        first[1:] |= cut[:-1]
        first[off[:-1][off[:-1] < off[1:]]] = True
        return np.flatnonzero(first)

    def matches(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All piece occurrences as (start, length, id). ends: the end of the unit of each byte."""
        at = np.flatnonzero((raw & 0xC0) != 0x80)  # characters begin here
        h = np.zeros(len(at), np.uint64)
        found = []
        for n in range(1, self.longest + 1):
            room = at + n <= ends[at]
            at, h = at[room], h[room]
            if not len(at):
                break
            h = h * MULTIPLIER + (raw[at + n - 1].astype(np.uint64) + np.uint64(1))
            slot = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[slot] == h
            at, h, piece = at[hit], h[hit], self.piece_at[slot[hit]]
            whole = piece >= 0
            found.append((at[whole].astype(np.int32), np.full(int(whole.sum()), n, np.int32), piece[whole].astype(np.int32)))
        return tuple(np.concatenate(x) if found else np.zeros(0, np.int32) for x in (zip(*found, strict=True) if found else ((), (), ())))

    def encode_units(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units end to end, and their offsets. No unit is empty."""
        lengths = off[1:] - off[:-1]
        unit = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        start, n, piece = self.matches(raw, off[1:][unit])
        score = self.scores[piece]
        # characters without a piece of their own
        heads = np.flatnonzero((raw & 0xC0) != 0x80)
        width = np.diff(np.append(heads, len(raw)))
        single = np.zeros(len(raw), np.int64)
        np.maximum.at(single, start, np.where(n == self._width_at(heads, width, len(raw))[start], n, 0))
        lone = single[heads] == 0
        start = np.concatenate([start, heads[lone].astype(np.int32)])
        n = np.concatenate([n, width[lone].astype(np.int32)])
        score = np.concatenate([score, np.full(int(lone.sum()), self.unknown)])
        piece = np.concatenate([piece, np.full(int(lone.sum()), -1, np.int32)])

        # by length of the unit, place in it and length of the piece
        step = (lengths[unit[start]] << 40) | ((start - off[unit[start]]) << 12) | n
        order = np.argsort(step, kind="stable")
        start, n, score, piece, step = (x[order] for x in (start, n, score, piece, step))
        del order
        best = np.full(len(raw) + len(lengths), -np.inf)  # best[off[u] + u + p]: units have one place more than bytes
        back = np.full(len(best), -1, np.int64)
        base = off[:-1] + np.arange(len(lengths))
        best[base] = 0.0
        slot = start + unit[start]
        small = int(np.searchsorted(step, (LONG_UNIT + 1) << 40, "left"))
        change = np.flatnonzero(np.diff(step[:small])) + 1
        for a, b in zip(np.concatenate([[0], change]).tolist() if small else [], np.append(change, small).tolist() if small else [], strict=True):
            source, target = slot[a:b], slot[a:b] + n[a]
            value = best[source] + score[a:b]
            better = value > best[target]
            target = target[better]
            best[target] = value[better]
            back[target] = np.arange(a, b)[better]
        for k in np.lexsort((n[small:], start[small:])) + small:  # a unit too long to have company
            target = slot[k] + n[k]
            if (value := best[slot[k]] + score[k]) > best[target]:
                best[target], back[target] = value, k
        # all units walk back together
        at, alive, steps = base + lengths, np.arange(len(lengths)), []
        while len(alive):
            k = back[at[alive]]
            steps.append((alive, k))
            at[alive] -= n[k]
            alive = alive[at[alive] > base[alive]]
        owner = np.concatenate([x for x, _ in steps]) if steps else np.zeros(0, np.int64)
        taken = np.concatenate([x for _, x in steps]) if steps else np.zeros(0, np.int64)
        order = np.lexsort((start[taken], owner))
        owner, taken = owner[order], taken[order]
        unknown = piece[taken] < 0
        repeat = np.where(unknown, n[taken], 1)
        ids = np.repeat(piece[taken], repeat)
        blank = np.repeat(unknown, repeat)
        if blank.any():
            from_byte = np.repeat(start[taken], repeat) + np.arange(len(ids)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
            ids[blank] = self.byte_ids[raw[from_byte[blank]]]
        out = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(np.bincount(owner, weights=repeat, minlength=len(lengths)).astype(np.int64), out=out[1:])
        return ids, out

    @staticmethod
    def _width_at(heads: np.ndarray, width: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[heads] = width
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of each. An empty text has no id."""
        raw, off = flat(texts)
        full = off[:-1] < off[1:]
        grown = np.insert(raw, off[:-1][full], 0x20)  # one space before each text that isn't empty
        off = off + np.concatenate([[0], np.cumsum(full)])
        if not len(grown):
            return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        starts = self.unit_starts(grown, off)
        codes, units = distinct(grown, starts, np.append(starts[1:], len(grown)))
        ids, unit_off = self.encode_units(*binary_parts(units))
        out, bounds = ragged_take(ids, unit_off, codes)
        return out, bounds[np.searchsorted(starts, off, "left")]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[bytes]:
        """The bytes of each id row, without the space that encoding puts before a text."""
        data, bounds = ragged_take(self.bytes_flat, self.bytes_off, ids)
        data, at = data.tobytes(), bounds[off].tolist()
        return [data[a + 1 : b] if data[a : a + 1] == b" " else data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def sentencepiece_encode(docs: DataFrame, model: PieceModel, text_col: str = "text", ids_col: str = "piece_ids", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """docs with an array<int> column of piece ids, in place of a column of that name.

    Null and empty texts give an empty array; repeated rows are encoded alike and all kept, in no new order;
    an empty table stays empty. Of encodings of equal score that of the longer last piece is taken.
    """
    docs = docs.drop(ids_col)
    schema = docs.select("*", F.array(F.lit(0)).alias(ids_col)).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, text_col, batch_bytes):
            ids, off = model.encode(batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(off.astype(np.int32), pa.array(ids.astype(np.int32)))], names=[*batch.schema.names, ids_col])

    return map_batches(docs, encode, schema)


def sentencepiece_decode(rows: DataFrame, model: PieceModel, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """rows with the text of each id array, in place of a column of that name; a null array gives null, an empty one an empty text."""
    rows = rows.drop(text_col)
    schema = rows.select("*", F.lit("").alias(text_col)).schema

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = batch.column(ids_col)
            ids = arrays.flatten().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = [0 if x is None else x for x in pa.compute.list_value_length(arrays).to_pylist()]
            texts = model.decode(ids, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.decode("utf-8", "replace") for x in texts], pa.string(), mask=arrays.is_null().to_numpy(zero_copy_only=False))], names=[*batch.schema.names, text_col])

    return map_batches(rows, decode, schema)


def sentencepiece_digest(docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, with_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_pieces, ids_crc32, n_bytes, round_trip, and piece_ids if asked for.

    ids_crc32 is of the ids as little-endian unsigned 32-bit integers; round_trip says whether decoding
    them gives the text. Null and empty texts have no piece (and round_trip). Repeated rows and ids are each
    told; an empty table gives no rows; other columns are not read. Nothing is shuffled.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text", batch_bytes):
            raw, off = flat(batch.column("text"))
            ids, bounds = model.encode(batch.column("text"))
            data, source, at = ids.astype("<u4").tobytes(), raw.tobytes(), off.tolist()
            same = [source[a:b] == x for a, b, x in zip(at[:-1], at[1:], model.decode(ids, bounds), strict=True)]
            ends = bounds.tolist()
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = {"doc_id": batch.column("doc_id"), "n_pieces": pa.array(np.diff(bounds)), "ids_crc32": pa.array(crc, pa.int64()), "n_bytes": pa.array(np.diff(off)), "round_trip": pa.array(same)}
            if with_ids:
                columns["piece_ids"] = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_batches(rows, digest, "doc_id long, n_pieces long, ids_crc32 long, n_bytes long, round_trip boolean" + ", piece_ids array<int>" * with_ids)
