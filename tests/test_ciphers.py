import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import ciphers as op
from textloom.functions import decoders as D
from textloom.functions.rules import FLAG
from textloom.plans.catalogue import QUERIES

PLAIN = re.compile(FLAG)


def every_key(text):
    return [(key, f) for line in op.long_lines(text) for key in range(1, 256) for f in PLAIN.findall(bytes(b ^ key for b in line).decode("utf-8", "ignore"))]


def every_clue(text, keys):
    turned = lambda line, k: bytes(b ^ k[i % len(k)] for i, b in enumerate(line)).decode("utf-8", "ignore")
    return [(key, f) for line in op.long_lines(text) for key in keys or [] if key for f in PLAIN.findall(turned(line, key.encode()))]


def hide(text, key):
    return bytes(b ^ key[i % len(key)] for i, b in enumerate(text.encode())).decode("utf-8", "replace")


lines = st.lists(st.tuples(st.sampled_from(["FLAG{a}", "xx cTf{b c}y", "picoCTF{q}", "HTB{é}CTF{2}", "cyBer{}", "Cyber{z} flag{", "plain words", "FLéAG{x}", "f l a g {x}"]), st.integers(0, 255), st.text(max_size=6)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(lines)
def test_differences_find_what_all_keys_find(parts):
    text = "\n".join(more + hide(flag, bytes([key])) + more for flag, key, more in parts)
    own = op.long_lines(text)
    tables = [bytes(b ^ key for b in range(256)) for key in range(256)]
    assert [(key, f) for k, key in op.single_keys(own) for f in PLAIN.findall(own[k].translate(tables[key]).decode("utf-8", "ignore"))] == every_key(text)


@settings(max_examples=200, deadline=None)
@given(lines, st.lists(st.sampled_from(["k", "!#", "key", "é", "longer key 1"]), max_size=4))
def test_clues_find_what_plain_loops_find(parts, keys):
    text = "\n".join(hide(flag, keys[n % len(keys)].encode()) if keys else flag for n, (flag, _, _) in enumerate(parts))
    own = op.long_lines(text)
    found = [(k, n, key, f) for n, key in enumerate(keys) for k, turned in op.lines_under(own, key.encode()) for f in PLAIN.findall(turned.decode("utf-8", "ignore"))]
    assert [(key, f) for _, _, key, f in sorted(found, key=lambda x: x[:2])] == every_clue(text, keys)


def test_few_keys_are_tried():
    rng = random.Random(1)
    text = "\n".join("".join(rng.choice("etaoin shrdlu") for _ in range(200)) for _ in range(200)) + "\n" + hide("flag{here}", b"\x21")
    assert len(op.single_keys(op.long_lines(text))) <= 3


def rotate(text, k):
    turn = lambda s: s[k:] + s[:k]
    return text.translate(str.maketrans(D.LOWER + D.UPPER, turn(D.LOWER) + turn(D.UPPER)))


def test_rotations_find_what_all_shifts_find(spark):
    rng = random.Random(4)
    flags = ["FLAG{a_1}", "picoCTF{zz}", "htb{Q}", "cyber{x}{y}", "flag{a}ctf{b}", "aaaFlag{", "noflagshere", "ctf{a}HTB{b}cyber{c}", "{abcdefghij{", "xyzabcflag{{}"]
    texts = [" ".join(rotate(rng.choice(flags), rng.randrange(26)) + "_" * rng.randrange(5) for _ in range(rng.randrange(40))) for _ in range(120)] + [None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    for most in (20, 3, None):
        found = {r.k: [tuple(x) for x in r.f] for r in df.select("k", D.rotated_flags(F.col("text"), most).alias("f")).collect()}
        for k, text in enumerate(texts):
            words = re.findall(r"[A-Za-z0-9_{}]{10,}", text or "")[:most]
            assert found[k] == [(s, f) for w in words for s in range(1, 26) for f in PLAIN.findall(rotate(w, s))]


def test_limits_can_be_lifted(spark):
    import base64

    flag = [f"FLAG{{number_{k}}}" for k in range(30)]
    coded = {"b32": [base64.b32encode(f.encode()).decode() for f in flag], "b85": [base64.b85encode(f.encode()).decode() for f in flag], "hex": [f.encode().hex() for f in flag], "b64": [base64.b64encode(f.encode()).decode() for f in flag]}
    row = spark.createDataFrame([{k: " ".join(v) for k, v in coded.items()}])
    n = lambda c: F.size(D.flags_of(c))
    for most, wanted in (({}, [10, 8, 15, 20]), ({"most": None}, [30] * 4)):
        got = row.select(n(D.base32_texts(F.col("b32"), **most)), n(D.base85_texts(F.col("b85"), **most)), n(D.hex_texts(F.col("hex"), **most)), n(D.base64_texts(F.col("b64"), **most))).first()
        assert list(got) == wanted
    mirrored = row.select(F.lit(" ".join(f"UOZT{{{k}_abcdefg}}" for k in range(30))).alias("x"))
    assert mirrored.select(F.size(D.atbash_flags(F.col("x"))), F.size(D.atbash_flags(F.col("x"), None))).first() == (15, 30)


def test_clue_query_against_brute_force(spark, tmp_path):
    texts = ["pin = 77\nxx " + hide("CTF{in the text}", b"77") + "\nend", "", None, "key: a\nno such line here", "é ü\nsecret: é\n" + hide("flag{u}", "é".encode())]
    pq.write_table(pa.Table.from_pylist([{"doc_id": i, "text": t, "lang": "en", "source": "s", "n_chars": 1} for i, t in enumerate(texts)]), str(tmp_path / "documents.parquet"))
    wanted = set()
    for i, t in enumerate(texts):
        key = "!" + "#" * (i % 4) + "$"
        whole = f"the password: {key}\n{hide(f'FLAG{{s_{i}}}', key.encode())}\n{t or ''}"
        found = re.findall(r"(?i)(?:password|passwd|pin|key|secret|pass|clue|code|token)\s*[:=]\s*(\S+)", whole) + re.findall(r"(?i)flag\s*is\s*protected\s*by\s*(\S+)", whole)
        bare = {v for v in (re.sub(r"""^['":;,.]+|['":;,.]+$""", "", f) for f in found) if 1 <= len(v) <= 32}
        wanted |= {(i, k, f) for k, f in every_clue(whole, sorted(bare))}
    got = {tuple(r) for r in QUERIES["xor_clue_scan"](spark, str(tmp_path)).collect()}
    assert got == wanted and (0, "77", "CTF{in the text}") in got and len({i for i, *_ in got}) == 5
