"""Flags under single-byte and repeating XOR keys, found without trying every key (Arrow batches).

Neighbouring bytes of a line keep their exclusive or under any single-byte key, so the openings of flags
have fixed differences: one pass over the differences finds every key that makes an opening, and a line is
decoded with those keys alone. Bytes below and from 0x80 are passed over apart, since those of the other
half can only vanish as invalid or break an opening; letters of either case differ in one bit, which is
left out.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.rules import FLAG

#: Every flag has one of these, in any case.
OPENINGS = (b"flag{", b"ctf{", b"htb{", b"cyber{")
CASE = np.uint8(0xDF)
#: The shortest line that is looked at, in bytes.
LEAST = 8
PATTERN = re.compile(FLAG)

KEYED = T.ArrayType(T.StructType([T.StructField("key", T.IntegerType()), T.StructField("flag", T.StringType())]))
CLUED = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("flag", T.StringType())]))


def long_lines(text: str | None) -> list[bytes]:
    lines = [line.strip().encode() for line in (text or "").splitlines()]
    return [line for line in lines if len(line) >= LEAST]


def _flat(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all lines, and the line of each byte."""
    return np.frombuffer(b"".join(lines), np.uint8), np.repeat(np.arange(len(lines)), np.array([len(x) for x in lines], np.int64))


def _runs(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where ``wanted`` starts in values."""
    n = len(values) - len(wanted) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(values[:n] == wanted[0])
    for k in range(1, len(wanted)):
        at = at[values[at + k] == wanted[k]]
    return at


def single_keys(lines: list[bytes]) -> list[tuple[int, int]]:
    """(line, key) of all single-byte keys under which a line could hold the opening of a flag, in order."""
    data, line = _flat(lines)
    found = set()
    for half in (data < 0x80, data >= 0x80):
        own, of = data[half], line[half]
        steps = (own[1:] ^ own[:-1]) & CASE
        for opening in OPENINGS:
            crib = np.frombuffer(opening, np.uint8)
            at = _runs(steps, (crib[1:] ^ crib[:-1]) & CASE)
            last = at + len(crib) - 1
            same = of[at] == of[last]
            found |= set(zip(of[at][same].tolist(), (own[last][same] ^ crib[-1]).tolist(), strict=True))
    return sorted((k, key) for k, key in found if key)


@F.pandas_udf(KEYED)
def xor_flags(text: pd.Series) -> pd.Series:
    """Flags of each line of eight bytes or more under the 255 single-byte keys: by line, key and place."""
    tables = [bytes(b ^ key for b in range(256)) for key in range(256)]

    def scan(value: str | None) -> list[dict]:
        lines = long_lines(value)
        return [{"key": key, "flag": f} for k, key in single_keys(lines) for f in PATTERN.findall(lines[k].translate(tables[key]).decode("utf-8", "ignore"))]

    return text.map(scan)


def lines_under(lines: list[bytes], key: bytes) -> list[tuple[int, bytes]]:
    """(line, decoded bytes) of the lines that could hold the opening of a flag under a repeating key, in order."""
    data, line = _flat(lines)
    bounds = np.cumsum([0, *[len(x) for x in lines]])
    place = np.arange(len(data)) - bounds[line]
    turned = data ^ np.frombuffer(key, np.uint8)[place % len(key)]
    plain = turned < 0x80
    own, of = turned[plain] | 0x20, line[plain]
    hit: set[int] = set()
    for opening in OPENINGS:
        at = _runs(own, np.frombuffer(opening, np.uint8) | 0x20)
        hit |= set(of[at][of[at] == of[at + len(opening) - 1]].tolist())
    return [(k, turned[bounds[k] : bounds[k + 1]].tobytes()) for k in sorted(hit)]


@F.pandas_udf(CLUED)
def xor_flags_by_keys(text: pd.Series, keys: pd.Series) -> pd.Series:
    """Flags of each line of eight bytes or more under each repeating key, which starts anew with each line: by line, key as given, and place. Empty keys are passed over."""

    def scan(value: str | None, given) -> list[dict]:
        lines, found = long_lines(value), []
        for n, key in enumerate([] if given is None or not lines else given):
            if key:
                found += [(k, n, {"key": key, "flag": f}) for k, turned in lines_under(lines, key.encode()) for f in PATTERN.findall(turned.decode("utf-8", "ignore"))]
        return [x for *_, x in sorted(found, key=lambda y: y[:2])]

    return pd.Series([scan(v, k) for v, k in zip(text, keys, strict=True)], dtype=object)
