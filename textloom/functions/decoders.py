"""Finding and decoding encoded strings in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.base_text import from_ascii85, from_base32, from_base85
from textloom.functions.rules import FLAG, MORSE
from textloom.functions.text import or_empty, strip

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def every(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(or_empty(text), F.lit(pattern), F.lit(group))


def flags(text: Column) -> Column:
    return every(text, FLAG)


def flags_of(decoded: Column) -> Column:
    """Flags of an array of decoded strings, in order; null strings have none."""
    return F.flatten(F.transform(F.filter(decoded, lambda d: d.isNotNull()), flags))


def utf8(data: Column) -> Column:
    """Bytes as text, without what is not valid UTF-8."""
    return F.regexp_replace(F.make_valid_utf8(data.cast("string")), "�", "")


def rotate(text: Column, shift: int) -> Column:
    turn = lambda s: s[shift % 26 :] + s[: shift % 26]
    return F.translate(text, LOWER + UPPER, turn(LOWER) + turn(UPPER))


def rotations(text: Column) -> Column:
    """array<struct<shift, text>> of the 25 shifts."""
    return F.array(*[F.struct(F.lit(k).alias("shift"), rotate(text, k).alias("text")) for k in range(1, 26)])


def atbash(text: Column) -> Column:
    return F.translate(text, LOWER + UPPER, LOWER[::-1] + UPPER[::-1])


def some(found: Column, most: int | None) -> Column:
    """The first ``most`` of an array; all if None."""
    return found if most is None else F.slice(found, 1, most)


def words_to_rotate(text: Column, most: int | None = 20) -> Column:
    return some(every(text, r"[A-Za-z0-9_{}]{10,}"), most)


#: Letters before the brace that opens a flag.
OPENINGS = ("flag", "ctf", "htb", "cyber")


def shifts_of(word: Column) -> Column:
    """Shifts from 1 to 25, ascending, under which a word has the opening of a flag.

    Letters keep their distances under any shift, so the last letter before a brace tells the only shift
    that could make an opening end there, and one comparison tells whether it does.
    """
    turns = F.array(*[F.lit(LOWER[k:] + LOWER[:k]) for k in range(26)])

    def of_opening(found: Column) -> Column:
        letters = F.lower(F.regexp_replace(found, r"\{", ""))
        shift = lambda o: F.pmod(F.lit(ord(o[-1])) - F.ascii(F.substring(letters, -1, 1)), F.lit(26))
        fits = lambda o: F.call_function("translate", F.substring(letters, -len(o), len(o)), F.lit(LOWER), F.element_at(turns, shift(o) + 1)) == o
        return F.array(*[F.when(fits(o) & (shift(o) > 0), shift(o)) for o in OPENINGS])

    return F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.transform(every(word, r"[A-Za-z]{3,5}\{"), of_opening)))))


def rotated_flags(text: Column, most: int | None = 20) -> Column:
    """array<struct<shift, flag>> of the first long words under each shift that makes an opening; all words if most is None."""
    turns = F.array(*[F.lit(LOWER[k:] + LOWER[:k] + UPPER[k:] + UPPER[:k]) for k in range(26)])
    turned = lambda w, k: flags(F.call_function("translate", w, F.lit(LOWER + UPPER), F.element_at(turns, k + 1)))
    of_shift = lambda w: lambda k: F.transform(turned(w, k), lambda f: F.struct(k.alias("shift"), f.alias("flag")))
    return F.flatten(F.transform(words_to_rotate(text, most), lambda w: F.flatten(F.transform(shifts_of(w), of_shift(w)))))


def atbash_flags(text: Column, most: int | None = 15) -> Column:
    return F.flatten(F.transform(words_to_rotate(text, most), lambda w: flags(atbash(w))))


def base64_texts(text: Column, most: int | None = 20) -> Column:
    """What the first base64-like strings decode to; null where one does not decode."""
    return F.transform(some(every(text, r"[A-Za-z0-9+/]{8,}={0,2}"), most), lambda s: strip(utf8(F.try_to_binary(F.when(F.char_length(s) % 4 == 0, s), F.lit("base64")))))


def base32_texts(text: Column, most: int | None = 10) -> Column:
    """What the first base32-like strings decode to; null where one does not decode."""
    return F.transform(some(every(text, r"[A-Z2-7]{10,}={0,6}"), most), lambda s: strip(utf8(from_base32(s))))


def base85_texts(text: Column, most: int | None = 8) -> Column:
    """What the first base85-like strings decode to, as base85 or else as Ascii85; null where one does not decode."""
    bare = lambda s: F.replace(F.replace(s, F.lit("<~"), F.lit("")), F.lit("~>"), F.lit(""))
    found = some(every(text, r"<~[!-u]+~>|[0-9a-zA-Z!#$%&()*+-;<=>?@^_`{|}~]{12,}"), most)
    return F.transform(F.transform(found, bare), lambda s: strip(utf8(F.coalesce(from_base85(s), from_ascii85(s)))))


def short_clues(decoded: Column) -> Column:
    """Decoded strings of 4 to 32 printable characters without a blank."""
    return F.filter(decoded, lambda d: d.isNotNull() & F.char_length(d).between(4, 32) & ~d.contains(" ") & ~d.rlike(r"[\p{C}\p{Z}]"))


def hex_texts(text: Column, most: int | None = 15) -> Column:
    return F.transform(F.filter(some(every(text, r"(?:0x)?([0-9a-fA-F]{16,})", 1), most), lambda h: F.char_length(h) % 2 == 0), lambda h: utf8(F.unhex(h)))


def bit_texts(text: Column, most: int | None = 5) -> Column:
    """Runs of four or more groups of eight bits."""
    octet = lambda b: F.lpad(F.conv(b, 2, 16), 2, "0")
    return F.transform(some(every(text, r"[01]{8}(?:\s+[01]{8}){3,}"), most), lambda run: utf8(F.unhex(F.array_join(F.transform(F.split(run, r"\s+"), octet), ""))))


def url_text(text: Column) -> Column:
    """Percent sequences decoded, everything else as it is; null if the result is not decodable."""
    safe = F.regexp_replace(F.regexp_replace(or_empty(text), r"%(?![0-9a-fA-F]{2})", "%25"), r"\+", "%2B")
    return F.try_url_decode(safe)


def hex_array_texts(text: Column) -> Column:
    """Arrays such as [0x46, 0x4C]: printable bytes as characters, others as dots."""
    code = lambda h: F.conv(F.substring(strip(h), 3, 2), 16, 10).cast("int")
    one = lambda h: F.when(code(h).between(32, 126), F.chr(code(h))).otherwise(".")
    return F.transform(every(text, r"\[\s*(0x[0-9a-fA-F]{2}(?:\s*,\s*0x[0-9a-fA-F]{2})+)\s*\]", 1), lambda a: F.array_join(F.transform(F.split(a, ","), one), ""))


def int_array_texts(text: Column) -> Column:
    """Arrays such as [70, 76] whose numbers are all printable."""
    arrays = F.transform(every(text, r"\[\s*([0-9]{2,3}(?:\s*,\s*[0-9]{2,3})+)\s*\]", 1), lambda a: F.transform(F.split(a, ","), lambda n: strip(n).cast("int")))
    return F.transform(F.filter(arrays, lambda a: F.forall(a, lambda n: n.between(32, 126))), lambda a: F.array_join(F.transform(a, lambda n: F.chr(n)), ""))


def escaped_texts(text: Column) -> Column:
    r"""Runs of four or more \x46 escapes."""
    return F.transform(every(text, r"(?:\\x[0-9a-fA-F]{2}){4,}"), lambda e: utf8(F.unhex(F.regexp_replace(e, r"\\x", ""))))


def morse_text(code: Column) -> Column:
    """Letters parted by a blank, words by three; unknown letters are left out."""
    table = F.create_map(*[F.lit(x) for pair in MORSE.items() for x in pair])
    word = lambda w: F.array_join(F.transform(F.filter(F.split(w, " "), lambda c: c != ""), lambda c: F.coalesce(F.try_element_at(table, c), F.lit(""))), "")
    words = F.filter(F.split(strip(or_empty(code)), "   "), lambda w: F.exists(F.split(w, " "), lambda c: c != ""))
    return F.array_join(F.transform(words, word), " ")


def morse_texts(text: Column) -> Column:
    return F.transform(every(text, r"[.\-]{1,6}(?:\s+[.\-]{1,6})+"), morse_text)


def dtmf_digits(text: Column) -> Column:
    """Digits after a DTMF mark, or else every run of four to eight digits."""
    marked = every(text, r"(?i)DTMF.*?(\d{3,8})", 1)
    return F.when(F.size(marked) > 0, marked).otherwise(every(text, r"\d{4,8}"))


def clues(text: Column) -> Column:
    """Values of key: value notes, bare of quotes and stops, of 1 to 32 characters."""
    found = F.concat(every(text, r"(?i)(?:password|passwd|pin|key|secret|pass|clue|code|token)\s*[:=]\s*(\S+)", 1), every(text, r"(?i)flag\s*is\s*protected\s*by\s*(\S+)", 1))
    bare = F.transform(found, lambda v: F.regexp_replace(v, r"""^['":;,.]+|['":;,.]+$""", ""))
    return F.array_distinct(F.filter(bare, lambda v: F.char_length(v).between(1, 32)))


def printable_strings(content: Column, least: int = 4, most: int = 800) -> Column:
    """Runs of printable ASCII in binary content, joined and capped."""
    runs = F.regexp_extract_all(F.decode(content, "ISO-8859-1"), F.lit("[\\x20-\\x7e]{%d,}" % least), F.lit(0))
    joined = F.array_join(runs, " | ")
    capped = F.concat(F.substring(joined, 1, most), F.lit(" ... [total "), F.size(runs), F.lit(" strings extracted]"))
    return F.when(F.size(runs) == 0, "[No ASCII strings found]").when(F.char_length(joined) > most, capped).otherwise(joined)


def magic_header(content: Column) -> Column:
    """The first 16 bytes as spaced upper-case hexadecimal."""
    return F.rtrim(F.regexp_replace(F.hex(F.substring(content, 1, 16)), "(..)", "$1 "))


def trailing_blank_lines(text: Column) -> Column:
    return F.size(F.filter(F.split(or_empty(text), r"\r\n|\r|\n"), lambda line: line.rlike(r"[ \t]$")))
