"""Queries that read whole tables and whole texts, against brute force."""

import base64
import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from textloom.functions.rules import FLAG
from textloom.plans.catalogue import ORACLES, QUERIES


@pytest.fixture
def folder(tmp_path):
    """Writes tables, as lists of rows, into a folder of their own."""

    def write(**tables):
        for name, rows in tables.items():
            pq.write_table(pa.Table.from_pylist(rows), str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def doc(i, text="t", source="src1"):
    return {"doc_id": i, "text": text, "lang": "en", "source": source, "n_chars": len(text)}


def test_xor_scan_reads_every_row(spark, folder):
    ids = [0, 7, 49, 50, 51, 1234, 99_999]
    want = set()
    for i in ids:
        turned = bytes(b ^ 2 for b in f"FLAG{{src1_{i}}}".encode())
        for key in range(1, 256):
            want |= {(i, key, f) for f in re.findall(FLAG, bytes(b ^ key for b in turned).decode("utf-8", "ignore"))}
    got = {(r.doc_id, r.key, r.flag) for r in QUERIES["xor_scan"](spark, folder(documents=[doc(i) for i in ids])).collect()}
    assert got == want and {i for i, _, _ in got} == set(ids)


def test_flag_extract_reads_whole_texts(spark, folder):
    texts = ["x" * 190 + " FLAG{across_the_cut} y", "word " * 3000 + "ctf{late} and HTB{later}", "FLAG{early}", ""]
    want = {i: ",".join([m[0] for m in re.finditer(FLAG, t)] + [f"FLAG{{src1_{i}}}", f"htb{{{i}}}"]) for i, t in enumerate(texts)}
    got = {r.doc_id: r.flags for r in QUERIES["flag_extract"](spark, folder(documents=[doc(i, t) for i, t in enumerate(texts)])).collect()}
    assert got == want


def test_reports_count_every_source(spark, folder):
    sources = ["src3", "src3", "src3", "src1", "src1", None, "bare", "bare"]
    docs = [doc(i, source=s) for i, s in enumerate(sources)]
    labels = [{"doc_id": i, "quality": int(i % 3 > 0), "toxic": int(i == 1)} for i in range(6)]  # none of source 'bare'
    data = folder(documents=docs, labels=labels)
    sums = QUERIES["report_rollup"](spark, data).first()
    assert (sums.reviewed, sums.accepted, sums.improved, sums.rejected, sums.categories) == (6, 4, 1, 2, 3)
    scores = [7 + i % 4 if i % 3 else i % 7 for i in range(6)]
    mean = sum(s for s in scores if s > 0) / sum(s > 0 for s in scores)
    ready = QUERIES["readiness_score"](spark, data).first()
    assert ready.mean_score == pytest.approx(mean)
    assert ready.readiness == pytest.approx(min(40, mean * 4) + 4 / 200 * 20 + 3 / 6 * 20 + 20)
    got = {r.category: (r.reviewed, r.accepted, r.avg_final_score, r.has_report) for r in QUERIES["report_completion"](spark, data).collect()}
    assert got == {"src3": (3, 2, sum(scores[:3]) / 3, True), "src1": (2, 1, sum(scores[3:5]) / 2, True), None: (1, 1, scores[5], True), "bare": (2, 2, 8.5, False)}


def test_telemetry_parse_keeps_every_row(spark, folder):
    values = [1.5, 0.0, -0.5, -2.25, None]
    data = folder(events=[{"event_id": i, "value": v} for i, v in enumerate(values)])
    got = {r.event_id: (r.used, r.reserved) for r in QUERIES["telemetry_parse"](spark, data).collect()}
    assert got == {i: (v, None if v is None else v + 1) for i, v in enumerate(values)}


def hidden(flag):
    turned = bytes(b ^ 2 for b in flag.encode()).decode()
    return {"base32": base64.b32encode(flag.encode()).decode(), "base85": base64.b85encode(flag.encode()).decode(), "xor": turned}


TEXTS = [f"plain words and more of them {h} then the rest\nsecond line" for h in hidden("FLAG{within_a_text}").values()] + ["", None, "nothing here", "ÀÉÎ õü " * 50, "abcdefgh YWJjZGVmZ2g= Y2x1ZV9oZXJl wébcdefgh"]


def test_base_decoders_search_whole_texts(spark, folder):
    data = folder(documents=[doc(i, t or "") | {"text": t} for i, t in enumerate(TEXTS)])
    got = {r.doc_id: r for r in QUERIES["base_decoders"](spark, data).collect()}
    for i, text in enumerate(TEXTS):
        own = f"FLAG{{src1_{i}}}"
        for name, pattern, most, decoders in (("base32", r"[A-Z2-7]{10,}={0,6}", 10, [lambda x: base64.b32decode(x, casefold=True)]), ("base85", r"<~[!-u]+~>|[0-9a-zA-Z!#$%&()*+-;<=>?@^_`{|}~]{12,}", 8, [base64.b85decode, base64.a85decode])):
            want = []
            for found in re.findall(pattern, hidden(own)[name] + "\n" + (text or ""))[:most]:
                for decode in decoders:
                    try:
                        want += re.findall(FLAG, decode(found.replace("<~", "").replace("~>", "").encode()).decode("utf-8", "ignore"))
                        break
                    except ValueError:
                        continue
            assert got[i][name] == ",".join(want) and own in want
    assert "within_a_text" in got[0].base32 and "within_a_text" in got[1].base85


def test_xor_scan_searches_whole_texts(spark, folder):
    data = folder(documents=[doc(i, t or "") | {"text": t} for i, t in enumerate(TEXTS)])
    want = set()
    for i, text in enumerate(TEXTS):
        for line in (hidden(f"FLAG{{src1_{i}}}")["xor"] + "\n" + (text or "")).splitlines():
            own = line.strip().encode()
            if len(own) >= 8:
                for key in range(1, 256):
                    want |= {(i, key, f) for f in re.findall(FLAG, bytes(b ^ key for b in own).decode("utf-8", "ignore"))}
    got = {(r.doc_id, r.key, r.flag) for r in QUERIES["xor_scan"](spark, data).collect()}
    assert got == want and (2, 2, "FLAG{within_a_text}") in got


def test_base64_clues_search_whole_texts(spark, folder):
    data = folder(documents=[doc(i, t or "") | {"text": t} for i, t in enumerate(TEXTS)])
    want = set()
    for i, text in enumerate(TEXTS):
        made = base64.b64encode(f"clue_{i}".encode()).decode()
        for found in re.findall(r"[A-Za-z0-9+/]{8,}={0,2}", made + "\n" + (text or ""))[:20]:
            if len(found) % 4 == 0:
                clue = base64.b64decode(found).decode("utf-8", "ignore").strip()
                if 4 <= len(clue) <= 32 and " " not in clue and clue.isprintable():
                    want.add((i, clue))
    got = {(r.doc_id, r.clue) for r in QUERIES["base64_clues"](spark, data).collect()}
    assert got == want and (7, "clue_here") in got


@pytest.mark.parametrize("name", ["zip_contents", "xor_scan", "xor_clue_scan"])
def test_batches_are_bounded_in_bytes(spark, data, name):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    QUERIES[name](spark, data)
    assert 0 < int(spark.conf.get(setting)) <= 4 << 20


def test_members_larger_than_a_batch(spark, monkeypatch):
    import io
    import zipfile

    from textloom.operators import artifacts

    monkeypatch.setattr(artifacts, "BATCH_BYTES", 1000)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(9):
            z.writestr(f"m{k}", "x" * 400 * k)
    files = spark.createDataFrame([("a", bytearray(held.getvalue())), ("b", bytearray(b"none")), ("c", bytearray(held.getvalue()))], "path string, content binary")
    got = sorted((r.path, r.member, len(r.data)) for r in artifacts.zip_members(files).collect())
    assert got == [(p, f"m{k}", 400 * k) for p in "ac" for k in range(9)]


def test_review_spreads_rows_that_ask_nothing(spark, data):
    from pyspark.sql import functions as F

    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        found = QUERIES["judge_review"](spark, data).where("status IN ('accepted', 'rejected')")
        assert found.select(F.spark_partition_id().alias("p"), "status").where("status = 'accepted'").select("p").distinct().count() > 1
    finally:
        for k in held:
            spark.conf.unset(k)


def test_instruction_to_user_keeps_to_its_sql_where_a_part_is_null_or_empty(spark, folder):
    spaces = [" ", "\t", "\n", "\x0b", "\f", "\r", "\x1c", "\x1f", "\x85", "\u00a0", "\u1680", "\u2003", "\u2028", "\u2029", "\u3000", "\u200b", "\ufeff", "\x00"]
    parts = [None, "", " \t\r\n", "a", "a\n \u2028", *[f"{x}a{x}b{x}" for x in spaces], *[f" {x} a {x} " for x in spaces], *spaces]
    rows = [{"doc_id": i, "text": x, "source": y, "lang": "en", "n_chars": 0} for i, (x, y) in enumerate([(x, y) for x in parts for y in ("s", None, "", " s\n")] + [("t", y) for y in parts])]
    at = folder(documents=rows)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{at}/documents.parquet')")
    want = con.execute(ORACLES["instruction_to_user"]).fetchall()
    got = [tuple(r) for r in QUERIES["instruction_to_user"](spark, at).collect()]
    assert sorted(got) == sorted(want) and len(got) == len(rows)
