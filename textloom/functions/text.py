"""Normalisation, token estimates, hashes and word sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as str.strip() and a Unicode \\s see it; Java's own \\s is ASCII only.
SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Characters per token of the length heuristic (fixed value).
CHARS_PER_TOKEN = 3.8


def let(value: Column, body) -> Column:
    """body(value) with value computed once: filters would compute a repeated expression at each place."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def strip_ascii(text: Column) -> Column:
    """Without outer blanks, tabs, line and form feeds and carriage returns: the white space of \\s in SQL."""
    return F.btrim(text, F.lit(" \t\n\f\r"))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def normalize_clean(text: Column) -> Column:
    """One kind of line end, at most one empty line, single blanks, no outer white space; case is kept."""
    lines = F.regexp_replace(or_empty(text), r"\r\n?", "\n")
    return strip(F.regexp_replace(F.regexp_replace(lines, r"\n{3,}", "\n\n"), r"[ \t]+", " "))


def normalize_fold(text: Column) -> Column:
    """Lower case, white space runs to one blank, no outer white space."""
    return strip(F.regexp_replace(F.lower(or_empty(text)), f"{SPACE}+", " "))


def fold_ends(text: Column) -> Column:
    """Lower case without outer white space; inner white space is kept."""
    return F.lower(strip(or_empty(text)))


def clean_markdown(text: Column) -> Column:
    """Links to their labels, at most one empty line; a lone carriage return is kept."""
    lines = F.regexp_replace(or_empty(text), r"\r\n", "\n")
    return strip(F.regexp_replace(F.regexp_replace(lines, r"\[([^\]]+)\]\([^\)]+\)", "$1"), r"\n{3,}", "\n\n"))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(or_empty(text), f"{SPACE}+"), lambda w: w != ""))


def estimate_tokens(text: Column) -> Column:
    """The larger of the word count and length / 3.8, cut to a whole number."""
    return F.greatest(word_count(text), (F.char_length(or_empty(text)) / F.lit(CHARS_PER_TOKEN)).cast("int"))


def manifest_tokens(text: Column) -> Column:
    """A quarter of the length, 1 at least."""
    return F.greatest(F.floor(F.char_length(or_empty(text)) / 4), F.lit(1)).cast("int")


def alpha_ratio(text: Column) -> Column:
    """Share of letters; null for an empty text."""
    return F.char_length(F.regexp_replace(text, r"[^\p{L}]", "")) / F.nullif(F.char_length(text), F.lit(0)).cast("double")


def word_set(text: Column) -> Column:
    """Distinct runs of word characters that are three or more of a-z, 0-9 and _ after lower-casing."""
    runs = F.regexp_extract_all(F.lower(or_empty(text)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.array_distinct(F.filter(runs, lambda w: w.rlike("^[a-z0-9_]{3,}$")))


def jaccard(a: Column, b: Column) -> Column:
    """|a & b| / |a | b| of two arrays; 0 where one is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)).cast("double"))


def triple_md5(instruction: Column, input_: Column, output: Column) -> Column:
    """MD5 of the three fields without separators."""
    return F.md5(F.concat(or_empty(instruction), or_empty(input_), or_empty(output)))


def pair_sha(user: Column, assistant: Column) -> Column:
    """SHA-256 of the folded pair."""
    return F.sha2(F.concat(normalize_fold(user), F.lit("|"), normalize_fold(assistant)), 256)


def pair_sha_ends(user: Column, assistant: Column) -> Column:
    """SHA-256 of the pair in lower case without outer white space."""
    return F.sha2(F.concat(fold_ends(user), F.lit("|"), fold_ends(assistant)), 256)


def triple_sha_ends(instruction: Column, input_: Column, output: Column) -> Column:
    return F.sha2(F.concat(fold_ends(instruction), fold_ends(input_), fold_ends(output)), 256)


def preview(text: Column, length: int, mark: str = "") -> Column:
    return F.concat(F.substring(text, 1, length), F.lit(mark))


def shuffle_key(*parts: Column, seed: int = 42) -> Column:
    """A reproducible sort key in place of a seeded shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def extract_json(text: Column) -> Column:
    """The JSON object of an answer: without code fences, or else from the first { to the last }; null if neither parses."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(strip(or_empty(text)), r"(?i)^```json\s*", ""), r"^```\s*", ""), r"\s*```$", "")
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    parses = lambda c: F.get_json_object(c, "$").isNotNull()
    return F.when(parses(bare), bare).when((inner != "") & parses(inner), inner)
