"""Pattern extraction and decoding over whole texts.

A made string goes before each text, so that every row has something to find; whatever the text itself
holds is looked for as well.
"""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import ciphers
from textloom.functions import decoders as D
from textloom.functions.rules import FLAG, MORSE
from textloom.operators import artifacts
from textloom.operators.batches import bound_batches
from textloom.plans import sqltext as S
from textloom.plans.registry import query, read

NAME = "'FLAG{' || coalesce(source, '') || '_' || doc_id || '}'"
LETTERS = D.LOWER + D.UPPER


def _flagged(spark, sf_dir):
    flag = F.concat(F.lit("FLAG{"), F.coalesce("source", F.lit("")), F.lit("_"), F.col("doc_id").cast("string"), F.lit("}"))
    return read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), flag.alias("flag"))


def _before_text(made):
    return F.concat(made, F.lit("\n"), F.col("text"))


def _searched(made: str, found: str, columns: str = "doc_id, unnest(flags) AS flag") -> str:
    # SQL of a scan: found makes the list flags from x, the made string and the whole text
    return f"WITH t AS (SELECT doc_id, {made} || chr(10) || coalesce(text, '') AS x FROM documents), f AS (SELECT doc_id, {found} AS flags FROM t) SELECT {columns} FROM f"


def _flags_in(decoded: str) -> str:
    return f"flatten(list_transform({decoded}, lambda d: CASE WHEN d IS NULL THEN [] ELSE regexp_extract_all(d, {S.quoted(FLAG)}) END))"


def _rotated(x: str, k: int) -> str:
    turned = D.LOWER[k:] + D.LOWER[:k] + D.UPPER[k:] + D.UPPER[:k]
    return f"translate({x}, '{LETTERS}', '{turned}')"


@query(_searched("''", f"regexp_extract_all(x || ' ' || name || ' htb{{' || doc_id || '}}', {S.quoted(FLAG)})", "doc_id, array_to_string(flags, ',') AS flags").replace("SELECT doc_id, '' || chr(10) || coalesce(text, '') AS x", f"SELECT doc_id, {NAME} AS name, coalesce(text, '') AS x"))
def flag_extract(spark, sf_dir):
    text = F.concat("text", F.lit(" "), "flag", F.lit(" htb{"), F.col("doc_id").cast("string"), F.lit("}"))
    return _flagged(spark, sf_dir).select("doc_id", F.array_join(D.flags(text), ",").alias("flags"))


_TURNED = "CASE doc_id % 25 + 1 " + " ".join(f"WHEN {k} THEN {_rotated(NAME, k)}" for k in range(1, 26)) + " END"
_SHIFTED = "[" + ", ".join(f"{{'shift': {k}, 'flags': regexp_extract_all({_rotated('w', k)}, {S.quoted(FLAG)})}}" for k in range(1, 26)) + "]"


@query(
    f"WITH t AS (SELECT doc_id, {_TURNED} || chr(10) || coalesce(text, '') AS x FROM documents), w AS (SELECT doc_id, unnest(regexp_extract_all(x, '[A-Za-z0-9_{{}}]{{10,}}')[1:20]) AS w FROM t), "
    f"s AS (SELECT doc_id, unnest({_SHIFTED}) AS s FROM w) SELECT doc_id, s.shift AS shift, unnest(s.flags) AS flag FROM s"
)
def rot_scan(spark, sf_dir):
    rows = _flagged(spark, sf_dir)
    turned = F.coalesce(*[F.when(F.col("doc_id") % 25 + 1 == k, D.rotate(F.col("flag"), k)) for k in range(1, 26)])
    return rows.select("doc_id", F.explode(D.rotated_flags(_before_text(turned))).alias("found")).select("doc_id", "found.shift", "found.flag")


_MIRROR = f"translate({{}}, '{LETTERS}', '{D.LOWER[::-1] + D.UPPER[::-1]}')"


@query(_searched(_MIRROR.format(NAME), _flags_in(f"list_transform(regexp_extract_all(x, '[A-Za-z0-9_{{}}]{{10,}}')[1:15], lambda w: {_MIRROR.format('w')})")))
def atbash_scan(spark, sf_dir):
    return _flagged(spark, sf_dir).select("doc_id", F.explode(D.atbash_flags(_before_text(D.atbash(F.col("flag"))))).alias("flag"))


@query(_searched(f"'dump 0x' || hex(encode({NAME})) || '.'", _flags_in("list_transform(list_filter(regexp_extract_all(x, '(?:0x)?([0-9a-fA-F]{16,})', 1)[1:15], lambda h: length(h) % 2 = 0), lambda h: try(decode(unhex(h))))")))
def hex_decode(spark, sf_dir):
    return _flagged(spark, sf_dir).select("doc_id", F.explode(D.flags_of(D.hex_texts(_before_text(F.concat(F.lit("dump 0x"), F.hex("flag"), F.lit(".")))))).alias("flag"))


@query(_searched(f"'payload: ' || to_base64(encode({NAME}))", _flags_in("list_transform(regexp_extract_all(x, '[A-Za-z0-9+/]{8,}={0,2}')[1:20], lambda s: CASE WHEN length(s) % 4 = 0 THEN try(decode(from_base64(s))) END)")))
def base64_decode(spark, sf_dir):
    return _flagged(spark, sf_dir).select("doc_id", F.explode(D.flags_of(D.base64_texts(_before_text(F.concat(F.lit("payload: "), F.base64(F.col("flag").cast("binary"))))))).alias("flag"))


@query()  # words of a text decode to bytes that are partly valid UTF-8: tested against brute force
def base64_clues(spark, sf_dir):
    note = F.base64(F.concat(F.lit("clue_"), F.col("doc_id").cast("string")).cast("binary"))
    return _flagged(spark, sf_dir).select("doc_id", F.explode(D.short_clues(D.base64_texts(_before_text(note)))).alias("clue"))


_OCTET = "lambda b: chr(list_sum(list_transform(range(8), lambda i: CASE WHEN b[i + 1:i + 1] = '1' THEN 1 << (7 - i) ELSE 0 END))::INT)"
_BITS = f"array_to_string(list_transform(string_split({NAME}, ''), lambda c: lpad(bin(ascii(c)), 8, '0')), ' ')"


@query(_searched(_BITS, _flags_in(f"list_transform(regexp_extract_all(x, '[01]{{8}}(?:\\s+[01]{{8}}){{3,}}')[1:5], lambda run: array_to_string(list_transform(string_split_regex(run, '\\s+'), {_OCTET}), ''))")))
def bits_decode(spark, sf_dir):
    bits = F.array_join(F.transform(F.filter(F.split("flag", ""), lambda c: c != ""), lambda c: F.lpad(F.bin(F.ascii(c)), 8, "0")), " ")
    return _flagged(spark, sf_dir).select("doc_id", F.explode(D.flags_of(D.bit_texts(_before_text(bits)))).alias("flag"))


@query(_searched(f"'100% ' || replace(replace({NAME}, '{{', '%7B'), '}}', '%7d') || ' a+b'", "url_decode(x)", "doc_id, flags AS decoded"))
def url_decode(spark, sf_dir):
    coded = F.concat(F.lit("100% "), F.regexp_replace(F.regexp_replace("flag", r"\{", "%7B"), r"\}", "%7d"), F.lit(" a+b"))
    return _flagged(spark, sf_dir).select("doc_id", D.url_text(_before_text(coded)).alias("decoded"))


_DIGIT = "CASE doc_id % 10 " + " ".join(f"WHEN {v} THEN '{k}'" for k, v in MORSE.items() if v.isdigit()) + " END"
_CODES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in MORSE.items()) + "}"
_WORDS = f"array_to_string(list_transform(list_filter(string_split(trim(r, e' \\t\\n\\r'), '   '), lambda w: trim(w, ' ') <> ''), lambda w: array_to_string(list_transform(list_filter(string_split(w, ' '), lambda c: c <> ''), lambda c: coalesce({_CODES}[c], '')), '')), ' ')"


@query(_searched(f"'... --- ...   ' || {_DIGIT}", f"list_transform(regexp_extract_all(x, '[.\\-]{{1,6}}(?:\\s+[.\\-]{{1,6}})+'), lambda r: {_WORDS})", "doc_id, array_to_string(flags, '|') AS decoded"))
def morse_decode(spark, sf_dir):
    digits = {v: k for k, v in MORSE.items() if v.isdigit()}
    last = F.coalesce(*[F.when(F.col("doc_id") % 10 == int(d), code) for d, code in digits.items()])
    return _flagged(spark, sf_dir).select("doc_id", F.array_join(D.morse_texts(_before_text(F.concat(F.lit("... --- ...   "), last))), "|").alias("decoded"))


def _each(x: str) -> str:
    return f"list_transform(string_split({NAME}, ''), lambda c: {x})"


_HEXES = "list_transform(regexp_extract_all(x, '\\[\\s*(0x[0-9a-fA-F]{2}(?:\\s*,\\s*0x[0-9a-fA-F]{2})+)\\s*\\]', 1), lambda a: array_to_string(list_transform(string_split(a, ','), lambda h: CASE WHEN trim(h)::INT BETWEEN 32 AND 126 THEN chr(trim(h)::INT) ELSE '.' END), ''))"
_INTS = "list_transform(list_filter(list_transform(regexp_extract_all(x, '\\[\\s*([0-9]{2,3}(?:\\s*,\\s*[0-9]{2,3})+)\\s*\\]', 1), lambda a: list_transform(string_split(a, ','), lambda n: trim(n)::INT)), lambda a: list_min(a) >= 32 AND list_max(a) <= 126), lambda a: array_to_string(list_transform(a, lambda n: chr(n)), ''))"
_ESCAPES = "list_transform(regexp_extract_all(x, '(?:\\\\x[0-9a-fA-F]{2}){4,}'), lambda e: try(decode(unhex(replace(e, '\\x', '')))))"
_MADE = (
    f"'x = [' || array_to_string({_each("'0x' || upper(to_hex(ascii(c)))")}, ', ') || '] [ ' || array_to_string({_each('ascii(c)::VARCHAR')}, ', ') || ' ] ' || "
    f"array_to_string({_each("chr(92) || 'x' || upper(to_hex(ascii(c)))")}, '')"
)


@query(
    f"WITH t AS (SELECT doc_id, {_MADE} || chr(10) || coalesce(text, '') AS x FROM documents) "
    f"SELECT doc_id, array_to_string({_flags_in(_HEXES)}, ',') AS from_hex, array_to_string({_flags_in(_INTS)}, ',') AS from_int, array_to_string({_flags_in(_ESCAPES)}, ',') AS from_escapes FROM t"
)
def literal_decode(spark, sf_dir):
    letters = F.filter(F.split("flag", ""), lambda c: c != "")
    hexes = F.concat(F.lit("x = ["), F.array_join(F.transform(letters, lambda c: F.concat(F.lit("0x"), F.hex(c))), ", "), F.lit("]"))
    ints = F.concat(F.lit("[ "), F.array_join(F.transform(letters, lambda c: F.ascii(c).cast("string")), ", "), F.lit(" ]"))
    escapes = F.array_join(F.transform(letters, lambda c: F.concat(F.lit("\\x"), F.hex(c))), "")
    text = _before_text(F.concat(hexes, F.lit(" "), ints, F.lit(" "), escapes))
    joined = lambda texts: F.array_join(D.flags_of(texts), ",")
    return _flagged(spark, sf_dir).select("doc_id", joined(D.hex_array_texts(text)).alias("from_hex"), joined(D.int_array_texts(text)).alias("from_int"), joined(D.escaped_texts(text)).alias("from_escapes"))


_NOTE = "CASE WHEN doc_id % 2 = 0 THEN 'dtmf tone ' || (10000 + doc_id) ELSE 'call 77' || lpad((doc_id % 1000)::VARCHAR, 4, '0') END || ' the secret: ''key' || doc_id || '''; done'"
_CLUES = (
    "list_concat(regexp_extract_all(x, '(?i)(?:password|passwd|pin|key|secret|pass|clue|code|token)\\s*[:=]\\s*(\\S+)', 1), regexp_extract_all(x, '(?i)flag\\s*is\\s*protected\\s*by\\s*(\\S+)', 1))"
)
_BARE = f"list_filter(list_transform({_CLUES}, lambda v: regexp_replace(v, '^[''\":;,.]+|[''\":;,.]+$', '', 'g')), lambda v: length(v) BETWEEN 1 AND 32)"


@query(
    f"WITH t AS (SELECT doc_id, {_NOTE} || chr(10) || coalesce(text, '') AS x FROM documents), m AS (SELECT *, regexp_extract_all(x, '(?i)DTMF.*?(\\d{{3,8}})', 1) AS marked FROM t) "
    f"SELECT doc_id, array_to_string(CASE WHEN len(marked) > 0 THEN marked ELSE regexp_extract_all(x, '\\d{{4,8}}') END, ',') AS digits, array_to_string(list_sort(list_distinct({_BARE})), ',') AS clues FROM m"
)
def clue_harvest(spark, sf_dir):
    n = F.col("doc_id")
    tones = F.when(n % 2 == 0, F.concat(F.lit("dtmf tone "), (n + 10000).cast("string"))).otherwise(F.concat(F.lit("call 77"), F.lpad((n % 1000).cast("string"), 4, "0")))
    text = _before_text(F.concat(tones, F.lit(" the secret: 'key"), n.cast("string"), F.lit("'; done")))
    return _flagged(spark, sf_dir).select("doc_id", F.array_join(D.dtmf_digits(text), ",").alias("digits"), F.array_join(F.sort_array(D.clues(text)), ",").alias("clues"))


_RUNS = "regexp_extract_all(coalesce(text, ''), '[ -~]{4,}')"


@query(
    f"WITH r AS (SELECT doc_id, coalesce(text, '') AS text, list_concat({_RUNS}, CASE WHEN doc_id % 2 = 0 THEN ['abcd', 'efghij'] ELSE [] END) AS runs FROM documents), j AS (SELECT *, array_to_string(runs, ' | ') AS joined FROM r) "
    "SELECT doc_id, CASE WHEN len(runs) = 0 THEN '[No ASCII strings found]' WHEN length(joined) > 800 THEN joined[1:800] || ' ... [total ' || len(runs) || ' strings extracted]' ELSE joined END AS strings, "
    "rtrim(regexp_replace((hex(encode(text)) || CASE WHEN doc_id % 2 = 0 THEN '00616263640065666768696A' ELSE '0061' END)[1:32], '(..)', '\\1 ', 'g')) AS header FROM j"
)
def binary_strings(spark, sf_dir):
    made = F.when(F.col("doc_id") % 2 == 0, F.unhex(F.lit("00616263640065666768696A"))).otherwise(F.unhex(F.lit("0061")))
    data = F.concat(F.col("text").cast("binary"), made)
    return _flagged(spark, sf_dir).select("doc_id", D.printable_strings(data).alias("strings"), D.magic_header(data).alias("header"))


@query("SELECT doc_id, len(list_filter(string_split_regex(text, '\\r\\n|\\r|\\n'), lambda l: regexp_matches(l, '[ \\t]$'))) > 3 AS anomaly FROM documents")
def whitespace_anomaly(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", (D.trailing_blank_lines(F.col("text")) > 3).alias("anomaly"))


_MEMBER = "regexp_replace(url, '^https?://', '') || CASE page_id % 5 WHEN 0 THEN '/a..b.txt' WHEN 1 THEN '/../up.txt' WHEN 2 THEN '/..' WHEN 3 THEN '\\win.txt' ELSE '' END"


@query(f"WITH m AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '/' ELSE '' END || {_MEMBER} AS name FROM pages) SELECT page_id, NOT (starts_with(name, '/') OR contains(name, '\\') OR list_contains(string_split(name, '/'), '..')) AS safe FROM m")
def path_safety(spark, sf_dir):
    n = F.col("page_id") % 5
    end = F.when(n == 0, "/a..b.txt").when(n == 1, "/../up.txt").when(n == 2, "/..").when(n == 3, "\\win.txt").otherwise("")
    name = F.concat(F.when(F.col("page_id") % 7 == 0, "/").otherwise(""), F.regexp_replace("url", "^https?://", ""), end)
    return read(spark, sf_dir, "pages").select("page_id", artifacts.safe_path(name).alias("safe"))


@query()  # no base32 or base85 in SQL: tested against brute force
def base_decoders(spark, sf_dir):
    @F.pandas_udf(T.StringType())
    def coded(flag: pd.Series, how: pd.Series) -> pd.Series:
        return pd.Series([(base64.b32encode if h == "32" else base64.b85encode)(f.encode()).decode() for f, h in zip(flag, how, strict=True)])

    joined = lambda texts: F.array_join(D.flags_of(texts), ",")
    return _flagged(spark, sf_dir).select("doc_id", joined(D.base32_texts(_before_text(coded("flag", F.lit("32"))))).alias("base32"), joined(D.base85_texts(_before_text(coded("flag", F.lit("85"))))).alias("base85"))


@query()  # 255 keys a line are too slow in SQL: tested against brute force
def xor_scan(spark, sf_dir):
    bound_batches(spark)
    turned = artifacts.xor_text(F.col("flag"), F.lit("\x02"))
    return _flagged(spark, sf_dir).select("doc_id", F.explode(ciphers.xor_flags(_before_text(turned))).alias("found")).select("doc_id", "found.key", "found.flag")


@query()  # no exclusive or of texts in SQL: tested against brute force
def xor_clue_scan(spark, sf_dir):
    """Each line under the keys that notes of the same text give away."""
    bound_batches(spark)
    key = F.concat(F.lit("!"), F.repeat(F.lit("#"), (F.col("doc_id") % 4).cast("int")), F.lit("$"))
    text = _before_text(F.concat(F.lit("the password: "), key, F.lit("\n"), artifacts.xor_text(F.col("flag"), key)))
    found = ciphers.xor_flags_by_keys(text, F.sort_array(D.clues(text)))
    return _flagged(spark, sf_dir).select("doc_id", F.explode(found).alias("found")).select("doc_id", "found.key", "found.flag")
