"""Whole Arrow batches of text as flat numpy arrays: bytes, word bounds, distinct words, ragged gathers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII white space: space and \\t \\n \\v \\f \\r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def regrouped(batches: Iterator[pa.RecordBatch], text: str, target_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about target_bytes of text (one row at least)."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + target_bytes - size, "right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - base)
            start = stop
            if size >= target_bytes or start < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held and sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of each; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def word_bounds(raw: np.ndarray, off: np.ndarray, inside: np.ndarray, alone: np.ndarray | None = None, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``inside``. No run crosses texts.

    A byte of ``alone`` is a run by itself; ``breaks`` has one place more than bytes and parts runs before a byte.
    """
    begins = np.zeros(len(raw) + 1, bool)
    begins[off] = True
    if alone is not None:
        begins[:-1] |= alone
        begins[1:] |= alone
    if breaks is not None:
        begins |= breaks
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside
    before[:-1] &= ~begins[:-1]
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    after &= ~begins[1:]
    return starts, np.flatnonzero(inside & ~after) + 1


def distinct(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Code of each run, and the distinct runs by code. Runs must be in order and not overlap."""
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=off[1:])
    step = np.zeros(len(raw) + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    data = raw[np.cumsum(step[:-1], dtype=np.int8).astype(bool)]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def binary_parts(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_binary array without nulls."""
    _, offsets, data = values.buffers()
    off = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def ragged_take(values: np.ndarray, off: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``codes`` of a ragged array end to end, and the offsets of the result."""
    lengths = (off[1:] - off[:-1])[codes]
    out = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    index = np.arange(out[-1], dtype=np.int64)
    index += np.repeat(off[codes] - out[:-1], lengths)
    return values[index], out
