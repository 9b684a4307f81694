"""Base32, base85 and Ascii85 in column expressions: groups of characters are numbers, numbers are bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the alphabets in order of value
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE85 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz!#$%&()*+-;<=>?@^_`{|}~"
TOP = 1 << 32


def _letters(group: Column) -> Column:
    return F.filter(F.split(group, ""), lambda c: c != "")


def _number(group: Column, base: int, value) -> Column:
    """The number that a group's characters write; null where one has no value."""
    return F.aggregate(_letters(group), F.lit(0).cast("long"), lambda acc, c: acc * base + value(c))


def _place(alphabet: str):
    return lambda c: F.nullif(F.instr(F.lit(alphabet), c), F.lit(0)) - 1


def _power(base: int, exponent: Column) -> Column:
    return F.element_at(F.array(*[F.lit(base**k).cast("long") for k in range(8)]), exponent.cast("int") + 1)


def _joined(parts: Column) -> Column:
    """Bytes of hexadecimal parts; null if one part is."""
    return F.when(~F.exists(parts, lambda p: p.isNull()), F.unhex(F.array_join(parts, "")))


def from_base32(text: Column) -> Column:
    """Bytes of upper-case base32 with its padding; null where length or padding is wrong."""
    bare = F.rtrim(text, F.lit("="))
    padding = F.char_length(text) - F.char_length(bare)

    def part(group: Column) -> Column:
        n = F.char_length(group)
        value = _number(group, 32, _place(BASE32)) * _power(32, 8 - n)
        return F.substring(F.lpad(F.hex(value), 10, "0"), F.lit(1), 2 * F.floor(5 * n / 8).cast("int"))

    return F.when((F.char_length(text) % 8 == 0) & padding.isin(0, 1, 3, 4, 6), _joined(F.transform(F.regexp_extract_all(bare, F.lit(".{1,8}"), F.lit(0)), part)))


def _part85(group: Column, value) -> Column:
    """Hexadecimal bytes of up to five characters, the highest digit standing for those that are missing; null beyond 32 bits."""
    n = F.char_length(group)
    number = _number(group, 85, value) * _power(85, 5 - n) + _power(85, 5 - n) - 1
    return F.when(number < TOP, F.substring(F.lpad(F.hex(number), 8, "0"), F.lit(1), (2 * (n - 1)).cast("int")))


def from_base85(text: Column) -> Column:
    """Bytes of base85; null where a character or a group has no value."""
    return _joined(F.transform(F.regexp_extract_all(text, F.lit("(?s).{1,5}"), F.lit(0)), lambda g: _part85(g, _place(BASE85))))


def from_ascii85(text: Column) -> Column:
    """Bytes of Ascii85 without its brackets, z for four zero bytes; null where a character or a group has no value, or z stands within a group."""
    groups = F.regexp_extract_all(text, F.lit("(?s)[!-u]{5}|z|[!-u]{1,4}|."), F.lit(0))
    last = F.size(groups) - 1
    whole = lambda g: F.when(g == "z", "00000000").otherwise(_part85(g, lambda c: F.when(c.between("!", "u"), F.ascii(c) - 33)))
    return _joined(F.transform(groups, lambda g, k: F.when((k == last) | (g == "z") | (F.char_length(g) == 5), whole(g))))
