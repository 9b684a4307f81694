"""Edge rows of normalisation, filters, classification and decoders, against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from textloom.functions import decoders as D
from textloom.functions import text as X
from textloom.operators import classify, filters


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first()[0]


TEXTS = ["", "  ", "a\r\nb\rc\n\n\n\nd", "\t x  y\t\tz ", "Straße ÇA va bien ", "x" * 21, "\u3000wide\u3000"]


@pytest.mark.parametrize("text", TEXTS)
def test_normalisers(spark, text):
    clean = re.sub(r"[ \t]+", " ", re.sub(r"\n{3,}", "\n\n", text.replace("\r\n", "\n").replace("\r", "\n"))).strip()
    assert one(spark, text, X.normalize_clean) == clean
    assert one(spark, clean, X.normalize_clean) == clean
    assert one(spark, text, X.normalize_fold) == re.sub(r"\s+", " ", text.lower()).strip()
    assert one(spark, text, X.estimate_tokens) == max(len(text.split()), int(len(text) / 3.8))


def test_nulls(spark):
    rows = spark.createDataFrame([(None,)], "t string")
    got = rows.select(X.normalize_clean(F.col("t")).alias("a"), X.estimate_tokens(F.col("t")).alias("b"), F.size(X.word_set(F.col("t"))).alias("c"), filters.is_low_quality(F.col("t"), "output").alias("d")).first()
    assert tuple(got) == ("", 0, 0, True)


def test_markdown(spark):
    assert one(spark, "[a](http://x) b\r\n\n\n\nc\rd ", X.clean_markdown) == "a b\n\nc\rd"


def test_word_set_needs_whole_runs(spark):
    assert sorted(one(spark, "café foo_1 ab Abc abc naïve x12", X.word_set)) == ["abc", "foo_1", "x12"]


@pytest.mark.parametrize(
    "text, field, bad",
    [
        ("a" * 19, "instruction", True), ("ab " * 7, "instruction", False), ("a" * 2001, "instruction", True), ("a" * 2000, "instruction", False),
        ("word " * 9, "output", True), ("word " * 11, "output", False), ("a" * 8001, "output", True), ("a" * 4001, "input", True),
        ("MAYBE this is a long enough instruction", "instruction", True), ("1234567890 " * 6, "output", True), ("abc456789 " * 6 + "  ", "output", False),
    ],
)
def test_low_quality(spark, text, field, bad):
    assert one(spark, text, lambda c: filters.is_low_quality(c, field)) is bad


def test_difficulty(spark):
    rows = spark.createDataFrame([("what is md5", "short"), ("x", "a use-after-free in tcache"), ("x", "rop chain"), ("x", "nothing"), (None, None)], "u string, a string")
    got = rows.select(classify.difficulty_v3(F.col("u"), F.col("a")), classify.difficulty_v2(F.col("u"), F.col("a"))).collect()
    assert [tuple(r) for r in got] == [("beginner", "beginner"), ("expert", "expert"), ("advanced", "advanced"), ("intermediate", "intermediate"), ("intermediate", "intermediate")]
    counted = spark.createDataFrame([("", "", "kernel"), ("", "", "rop and rsa"), ("", "", "rop"), ("", "", "nmap"), ("", "", "plain"), ("", "", "rop " + "z" * 800), ("", "", "z" * 301)], "i string, p string, o string")
    assert [r[0] for r in counted.select(classify.difficulty_counted(F.col("i"), F.col("p"), F.col("o"))).collect()] == ["expert", "advanced", "intermediate", "intermediate", "beginner", "advanced", "intermediate"]


def test_category(spark):
    rows = spark.createDataFrame([("Web_Exploitation",), ("CRYPTO",), (None,), ("",), ("ransomware notes",), ("gtfo bins",)], "c string")
    assert [r[0] for r in rows.select(classify.normalize_category(F.col("c"))).collect()] == ["web exploitation", "crypto", "general security", "general security", "malware analysis", "linux security"]


def test_keys_present_or_null(spark):
    line = '{"instruction": null, "input": "", "output": "o"}'
    assert one(spark, line, lambda c: filters.has_keys(c, ("instruction", "input", "output"))) is True
    assert one(spark, '{"input": ""}', lambda c: filters.has_keys(c, ("instruction",))) is False
    assert one(spark, "nope", lambda c: filters.has_keys(c, ("instruction",))) is False


def test_extract_json(spark):
    assert one(spark, '```json\n{"a": 1}\n```', X.extract_json) == '{"a": 1}'
    assert one(spark, 'so {"a": {"b": 2}} it is', X.extract_json) == '{"a": {"b": 2}}'
    assert one(spark, "none here", X.extract_json) is None


def test_decoders(spark):
    assert one(spark, "RkxBR3thYmN9", lambda c: D.flags_of(D.base64_texts(c))) == ["FLAG{abc}"]
    assert one(spark, "100% sure", D.url_text) == "100% sure"
    assert one(spark, "a%20b+c%7", D.url_text) == "a b+c%7"
    assert one(spark, "[70, 999]", D.int_array_texts) == []
    assert one(spark, "... --- ...   .- ........", D.morse_text) == "SOS A"
    assert one(spark, None, D.flags) == []
