"""Files written from the tables and read back by the sources; feeds, answers and artefacts made of rows."""

from __future__ import annotations

import io
import wave
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators import artifacts, convert
from textloom.operators.batches import bound_batches
from textloom.plans import sqltext as S
from textloom.plans.pipelines import ensure_checkpoint_dir
from textloom.plans.registry import fresh_folder, query, read
from textloom.sources import atomic, jsonl
from textloom.sources.lines import numbered_lines

EXAMPLES = "SELECT doc_id, coalesce(source, 'none') AS source, coalesce(lang, '') AS instruction, coalesce(text, '') AS output FROM documents"


def _examples(spark, sf_dir):
    """doc_id, source, and a JSON line of an example."""
    docs = read(spark, sf_dir, "documents")
    record = F.struct(F.coalesce("lang", F.lit("")).alias("instruction"), F.col("doc_id").cast("string").alias("input"), F.coalesce("text", F.lit("")).alias("output"))
    return docs.select("doc_id", F.coalesce("source", F.lit("none")).alias("source"), F.to_json(record).alias("line"))


def _written(rows, spark, tag, *folders):
    path = fresh_folder(spark, tag)
    writer = rows.write.partitionBy(*folders) if folders else rows.write
    writer.text(path)
    return path


def _read_examples(found):
    return found.select(F.col("input").cast("long").alias("doc_id"), "instruction", F.md5("output").alias("output_md5"))


@query(f"SELECT doc_id, instruction, md5(output) AS output_md5 FROM ({EXAMPLES}) WHERE doc_id % 7 <> 3")
def jsonl_lenient(spark, sf_dir):
    """Every seventh line is cut off, and blank ones and a byte-order mark stand between: bad lines go silently."""
    rows = _examples(spark, sf_dir)
    line = F.when(F.col("doc_id") % 7 == 3, F.expr("substring(line, 1, length(line) - 1)")).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("﻿"), "line", F.lit("\n  \n"))).otherwise(F.concat(F.lit(" "), "line"))
    return _read_examples(jsonl.read_records(spark, jsonl.renamed(spark, _written(rows.select(line), spark, "lenient")), jsonl.EXAMPLE))


@query("SELECT count(*) AS total, count(*) FILTER (doc_id % 7 = 3) AS bad, count(DISTINCT doc_id) FILTER (doc_id % 7 <> 3) AS good FROM documents")
def jsonl_strict_counts(spark, sf_dir):
    rows = _examples(spark, sf_dir).select(F.when(F.col("doc_id") % 7 == 3, F.concat(F.lit("not "), "line")).otherwise(F.col("line")))
    ensure_checkpoint_dir(spark)
    lines = jsonl.parsed(numbered_lines(spark, _written(rows, spark, "strict")).where("line != ''"), jsonl.EXAMPLE)
    return lines.agg(F.count(F.lit(1)).alias("total"), F.count_if("bad").alias("bad"), F.countDistinct(F.when(~F.col("bad"), F.col("record.input"))).alias("good"))


@query(f"SELECT doc_id, 'source=' || source AS category, instruction, md5(output) AS output_md5 FROM ({EXAMPLES}) WHERE doc_id % 9 <> 2")
def category_folders(spark, sf_dir):
    """A folder a source; lines that lack a field are left out."""
    rows = _examples(spark, sf_dir).select("source", F.when(F.col("doc_id") % 9 == 2, F.replace("line", F.lit('"instruction"'), F.lit('"task"'))).otherwise(F.col("line")).alias("line"))
    found = jsonl.read_category_folders(spark, jsonl.renamed(spark, _written(rows, spark, "categories", "source")), jsonl.EXAMPLE)
    return found.select(F.col("input").cast("long").alias("doc_id"), F.col("_category").alias("category"), "instruction", F.md5("output").alias("output_md5"))


@query(f"SELECT doc_id, instruction, md5(output) AS output_md5 FROM ({EXAMPLES})")
def recursive_scan(spark, sf_dir):
    rows = _examples(spark, sf_dir).select("source", (F.col("doc_id") % 2).alias("half"), "line")
    return _read_examples(jsonl.read_records(spark, jsonl.renamed(spark, _written(rows, spark, "recursive", "source", "half")), jsonl.EXAMPLE, recursive=True))


@query("SELECT page_id, url, md5(html) AS html_md5 FROM pages")
def json_objects(spark, sf_dir):
    """Files of one JSON array over many lines, each of sixty-four pages or so."""
    item = F.to_json(F.struct("page_id", "url", "html"), {"pretty": "true"})
    bundles = read(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 64).alias("bundle"), item.alias("item")).groupBy("bundle").agg(F.collect_list("item").alias("items"))
    whole = bundles.select(F.concat(F.lit("[\n"), F.array_join("items", ",\n"), F.lit("\n]")).alias("value"))
    path = fresh_folder(spark, "objects")
    whole.repartition(F.col("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", "1").text(path)
    found = jsonl.read_json_objects(spark, path, T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]))
    return found.select("page_id", "url", F.md5("html").alias("html_md5"))


@query("SELECT item_id, md5(coalesce(text, '')) AS content_md5 FROM benchmark")
def document_files(spark, sf_dir):
    """A file each; the name of its folder is the id."""
    path = fresh_folder(spark, "files")
    read(spark, sf_dir, "benchmark").select("item_id", F.coalesce("text", F.lit("")).alias("value")).repartition("item_id").write.partitionBy("item_id").option("lineSep", "\u0001").text(path)
    found = jsonl.read_documents(spark, f"{path}/*/*.txt").select(F.regexp_extract("folder", r"(\d+)", 1).cast("long").alias("item_id"), F.rtrim("content", F.lit("\u0001")).alias("content"))
    return found.select("item_id", F.md5("content").alias("content_md5"))


@query("SELECT conv_id, role, md5(text) AS content_md5 FROM conversations")
def chat_sink(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select(F.array(F.struct("role", F.col("text").alias("content"))).alias("messages"), F.col("conv_id").cast("string").alias("category"), F.lit(0).alias("turn"))
    path = fresh_folder(spark, "chat")
    jsonl.write_chat(turns, path)
    found = jsonl.parsed(jsonl.read_lines(spark, path, glob="*.json"))
    return found.select(F.col("record.category").cast("long").alias("conv_id"), F.explode("record.messages").alias("m")).select("conv_id", "m.role", F.md5("m.content").alias("content_md5"))


@query(f"SELECT doc_id, instruction, md5(output) AS output_md5 FROM ({EXAMPLES})")
def raw_sink(spark, sf_dir):
    """Columns that open with an underscore are not written."""
    rows = read(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("")).alias("instruction"), F.col("doc_id").cast("string").alias("input"), F.coalesce("text", F.lit("")).alias("output"), F.lit("x").alias("_note"))
    path = fresh_folder(spark, "raw")
    jsonl.write_raw(rows, path)
    found = jsonl.parsed(jsonl.read_lines(spark, path, glob="*.json"), jsonl.EXAMPLE).where("NOT line LIKE '%\"_note\"%'").select("record.*")
    return _read_examples(found)


@query("SELECT event_id::INT AS step, user_id / 4.0::DOUBLE AS epoch, value AS loss, CASE WHEN event_id % 3 = 0 THEN value END AS val_loss, event_type AS gpu_util FROM events")
def telemetry_csv(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    none = F.lit(None).cast("double")
    rows = e.select(F.col("event_id").cast("int").alias("step"), (F.col("user_id") / 4.0).alias("epoch"), F.col("value").alias("loss"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("val_loss"), none.alias("learning_rate"), F.lit("1.0 / 2.0 GB").alias("gpu_vram"), F.col("event_type").alias("gpu_util"), none.alias("elapsed_seconds"))
    path = fresh_folder(spark, "telemetry")
    jsonl.write_telemetry(rows, path)
    return jsonl.read_telemetry(spark, path).select("step", "epoch", "loss", "val_loss", "gpu_util")


@query("""
WITH d AS (SELECT coalesce(source, 'none') AS source, md5(coalesce(text, '')) AS h, doc_id % 2 AS half FROM documents),
a AS (SELECT source, h FROM (SELECT h, min(source) AS source FROM d WHERE half = 0 GROUP BY h) QUALIFY row_number() OVER (PARTITION BY source ORDER BY h) <= 20),
b AS (SELECT source, h, row_number() OVER (PARTITION BY source ORDER BY h) AS nth FROM (SELECT h, min(source) AS source FROM d WHERE half = 1 GROUP BY h) WHERE h NOT IN (SELECT h FROM a)),
held AS (SELECT source, count(*) AS n FROM a GROUP BY source)
SELECT source, h FROM a UNION ALL SELECT b.source, b.h FROM b LEFT JOIN held USING (source) WHERE nth <= 20 - coalesce(n, 0)
""")
def append_resume(spark, sf_dir):
    """Two appends of at most twenty rows a source in all; what is there is never written again."""
    docs = read(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("none")).alias("source"), F.md5(F.coalesce("text", F.lit(""))).alias("h"), (F.col("doc_id") % 2).alias("half"))
    path = fresh_folder(spark, "appended")
    for half in (0, 1):
        rows = docs.where(F.col("half") == half).groupBy("h").agg(F.min("source").alias("source"))
        jsonl.append_unseen(rows, path, F.col("h"), 20, "source")
    return spark.read.parquet(path).select("source", "h")


@query(f"SELECT doc_id, instruction, md5(output) AS output_md5 FROM ({EXAMPLES}) WHERE doc_id % 4 <> 1")
def clean_response(spark, sf_dir):
    """Answers of a model: fenced lines, a comment, a blank, and an object that lacks a key."""
    line = F.when(F.col("doc_id") % 4 == 1, F.lit('{"instruction": "a", "input": "b"}')).when(F.col("doc_id") % 4 == 2, F.concat(F.lit("```json "), "line", F.lit("```"))).otherwise(F.col("line"))
    answers = _examples(spark, sf_dir).select(F.concat(F.lit("Here you are:\n```json\n\n"), line, F.lit("\n{broken}\n```")).alias("answer"))
    return _read_examples(answers.select(F.explode(jsonl.response_examples(F.col("answer"))).alias("r")).select("r.*"))


def _filled(template: str, parts: dict[str, str]) -> str:
    out = S.quoted(template)
    for name, sql in parts.items():
        out = f"replace({out}, '{{{name}}}', {sql})"
    return out


def _converted(rows: str, instruction: str, input_: str, output: str, category: str, source: str, difficulty: str) -> str:
    return f"WITH r AS ({rows}) SELECT {S.quoted(instruction)} AS instruction, {input_} AS input, {output} AS output, '{category}' AS category, '{source}' AS source, {difficulty} AS difficulty FROM r"


_DESCRIPTION = S.markdown("coalesce(text, '')")


@query(
    _converted(
        f"SELECT 'T' || doc_id AS id, 'N ' || lang AS name, {_DESCRIPTION} AS description, CASE WHEN doc_id % 2 = 0 THEN 'Linux, ' || lang ELSE 'All' END AS platforms, CASE WHEN doc_id % 3 = 0 THEN 'p1, ' || lang ELSE 'Execution / Persistence' END AS tactics, CASE WHEN doc_id % 5 = 0 THEN 'watch ' || lang ELSE 'Monitor command execution logs, API calls, and authentication events.' END AS detection FROM documents WHERE doc_id % 11 <> 4 AND doc_id % 13 <> 5 AND {_DESCRIPTION} <> ''",
        "Explain this attack technique.",
        "'Technique ID: ' || id || chr(10) || 'Technique Name: ' || name || chr(10) || 'Tactics: ' || tactics || chr(10) || 'Platforms: ' || platforms || chr(10) || 'Description: ' || description[1:400] || '...'",
        _filled(convert.TECHNIQUE, {"id": "id", "name": "name", "tactics": "tactics", "platforms": "platforms", "detection": "detection", "description": "description"}),
        "threat_intelligence", "mitre_attack", "CASE WHEN regexp_matches(lower(description), 'kernel|injection|bypass') THEN 'advanced' ELSE 'intermediate' END",
    )
)
def convert_techniques(spark, sf_dir):
    n = F.col("doc_id")
    given = lambda m, value: F.when(n % m == 0, value)
    reference = F.struct(F.lit("mitre-attack").alias("source_name"), F.concat(F.lit("T"), n.cast("string")).alias("external_id"))
    objects = read(spark, sf_dir, "documents").select(
        F.when(n % 11 == 4, "malware").otherwise("attack-pattern").alias("type"), F.when(n % 13 == 5, True).alias("revoked"), F.concat(F.lit("N "), "lang").alias("name"), F.col("text").alias("description"),
        F.array(F.struct(F.lit("other").alias("source_name"), F.lit("x").alias("external_id")), reference).alias("external_references"), given(2, F.array(F.lit("Linux"), F.col("lang"))).alias("x_mitre_platforms"),
        given(3, F.array(F.struct(F.lit("p1").alias("phase_name")), F.struct(F.col("lang").alias("phase_name")))).alias("kill_chain_phases"), given(5, F.concat(F.lit("watch "), "lang")).alias("x_mitre_detection"),
    )
    return convert.techniques(objects)


@query(
    _converted(
        f"SELECT 'CVE-' || doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'Unknown' END AS vendor, CASE WHEN doc_id % 3 = 0 THEN source ELSE 'Unknown' END AS product, CASE WHEN doc_id % 4 = 0 THEN 'RCE ' || lang ELSE lang END AS name, {_DESCRIPTION} AS description, CASE WHEN doc_id % 5 = 0 THEN 'patch ' || lang ELSE 'Apply vendor updates according to instructions.' END AS action, CASE WHEN doc_id % 6 = 0 THEN 'Known' ELSE 'Unknown' END AS ransomware, CASE WHEN doc_id % 7 = 0 THEN 'CWE-1, CWE-' || doc_id ELSE 'General Vulnerability (CWE-Top25)' END AS cwes FROM documents WHERE {_DESCRIPTION} <> ''",
        "Analyze this vulnerability and explain exploitation and remediation.",
        "'CVE: ' || id || chr(10) || 'Affected Software: ' || vendor || ' ' || product || chr(10) || 'Vulnerability Name: ' || name || chr(10) || 'CWE: ' || cwes || chr(10) || 'Description: ' || description",
        _filled(convert.VULNERABILITY, {"id": "id", "vendor": "vendor", "product": "product", "name": "name", "cwes": "cwes", "ransomware": "ransomware", "action": "action", "description": "description"}),
        "vulnerabilities", "cisa_kev", "CASE WHEN contains(lower(name), 'rce') OR regexp_matches(lower(description), 'overflow|injection') THEN 'advanced' ELSE 'intermediate' END",
    )
)
def convert_vulnerabilities(spark, sf_dir):
    n = F.col("doc_id")
    given = lambda m, value: F.when(n % m == 0, value)
    entries = read(spark, sf_dir, "documents").select(
        F.concat(F.lit("CVE-"), n.cast("string")).alias("cveID"), given(2, F.col("lang")).alias("vendorProject"), given(3, F.col("source")).alias("product"), F.when(n % 4 == 0, F.concat(F.lit("RCE "), "lang")).otherwise(F.col("lang")).alias("vulnerabilityName"),
        F.col("text").alias("shortDescription"), given(5, F.concat(F.lit("patch "), "lang")).alias("requiredAction"), given(6, F.lit("Known")).alias("knownRansomwareCampaignUse"), given(7, F.array(F.lit("CWE-1"), F.concat(F.lit("CWE-"), n.cast("string")))).alias("cwes"),
    )
    return convert.vulnerabilities(entries)


@query(
    _converted(
        "SELECT 'F' || doc_id AS family, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'Unknown Actor' END AS actor, 'T1, ' || lang AS techniques, 'in ' || lang AS access, 'run ' || lang AS execution, 'hide ' || lang AS evasion, coalesce(text, '') AS remediation, CASE WHEN doc_id % 3 = 0 THEN md5(lang) || ', b' ELSE 'N/A' END AS sha256, 'N/A' AS registry_keys, CASE WHEN doc_id % 3 = 0 THEN lang || '.example' ELSE 'N/A' END AS network_domains FROM documents",
        "Perform malware analysis.",
        "'Malware Family: ' || family || chr(10) || 'Threat Actor: ' || actor || chr(10) || 'Technical Summary: Threat advisory report for ' || family || ' campaign.'",
        _filled(convert.MALWARE, {c: c for c in ("family", "actor", "techniques", "access", "execution", "evasion", "sha256", "registry_keys", "network_domains", "remediation")}),
        "malware", "cisa_threat_advisories", "'expert'",
    )
)
def convert_malware(spark, sf_dir):
    n = F.col("doc_id")
    iocs = F.when(n % 3 == 0, F.create_map(F.lit("sha256"), F.array(F.md5("lang"), F.lit("b")), F.lit("network_domains"), F.array(F.concat("lang", F.lit(".example")))))
    content = F.struct(
        F.when(n % 2 == 0, F.col("source")).alias("threat_actor"), F.concat(F.lit("in "), "lang").alias("initial_access"), F.concat(F.lit("run "), "lang").alias("execution_mechanism"),
        F.concat(F.lit("hide "), "lang").alias("defense_evasion"), F.coalesce("text", F.lit("")).alias("remediation"), F.coalesce(iocs, F.create_map().cast("map<string,array<string>>")).alias("indicators_of_compromise"),
    )
    return convert.malware_reports(read(spark, sf_dir, "documents").select(F.concat(F.lit("F"), n.cast("string")).alias("family"), F.array(F.lit("T1"), F.col("lang")).alias("mitre_techniques"), content.alias("content")))


@query(
    _converted(
        f"SELECT CASE WHEN doc_id % 2 = 0 THEN 'Heading ' || doc_id ELSE 'Some-Name 2Fa It''S X' || doc_id END AS title, {S.markdown('content[1:700]')} AS opening FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '# Heading ' || doc_id || chr(10) ELSE '' END || replace(coalesce(text, ''), '#', '') AS content FROM documents)",
        "Analyze this security threat and detail prevention controls.", "'Threat Category: ' || title || chr(10) || 'Context: Web Application Vulnerability & Architecture Risk'",
        _filled(convert.ARTICLE, {"opening": "opening"}), "security_corpus", "owasp_guidance", "'intermediate'",
    )
)
def convert_articles(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    heading = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("# Heading "), n, F.lit("\n"))).otherwise("")
    docs = read(spark, sf_dir, "documents").select(F.concat(F.lit("some-naME_2fa_it's_x"), n).alias("stem"), F.concat(heading, F.replace(F.coalesce("text", F.lit("")), F.lit("#"), F.lit(""))).alias("content"))
    return convert.articles(docs)


@query("SELECT doc_id, md5(coalesce(text, '') || CASE WHEN doc_id % 3 = 1 THEN chr(65533) ELSE '' END) AS text_md5 FROM documents")
def file_texts(spark, sf_dir):
    name = F.concat(F.lit("a"), F.when(F.col("doc_id") % 2 == 0, ".txt").otherwise(".bin"))
    data = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.when(F.col("doc_id") % 3 == 1, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(artifacts.file_text(name, data)).alias("text_md5"))


@query("SELECT event_id, 1 + (event_id % 2)::INT AS channels, 8000 AS sample_rate_hz, 16 AS bit_depth, (event_id % 50) * 80 AS total_frames, round((event_id % 50) * 80 / 8000.0::DOUBLE, 2) AS duration_seconds FROM events")
def wav_headers(spark, sf_dir):
    @F.pandas_udf("binary")
    def sounded(n: pd.Series) -> pd.Series:
        out = []
        for k in n:
            held = io.BytesIO()
            with wave.open(held, "wb") as w:
                w.setnchannels(1 + k % 2)
                w.setsampwidth(2)
                w.setframerate(8000)
                w.writeframes(bytes((k % 50) * 80 * 2 * (1 + k % 2)))
            out.append(held.getvalue())
        return pd.Series(out)

    return read(spark, sf_dir, "events").select("event_id", artifacts.wav_header(sounded("event_id")).alias("h")).select("event_id", "h.*")


@query("""
SELECT doc_id, depth, member, size FROM (SELECT doc_id, 1 AS depth, 'a/text.txt' AS member, octet_length(encode(coalesce(text, '')))::BIGINT AS size FROM documents
UNION ALL SELECT doc_id, 2, 'deep.txt', octet_length(encode(doc_id::VARCHAR))::BIGINT FROM documents WHERE doc_id % 4 = 0)
""")
def zip_contents(spark, sf_dir):
    """Archives with a text, and in every fourth one an archive within; the inner archives' own rows are left out, their sizes being the packer's."""

    @F.pandas_udf("binary")
    def packed(n: pd.Series, text: pd.Series) -> pd.Series:
        out = []
        for k, t in zip(n, text, strict=True):
            held, inner = io.BytesIO(), io.BytesIO()
            with zipfile.ZipFile(inner, "w") as z:
                z.writestr("deep.txt", str(k))
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("folder/", "")
                z.writestr("a/text.txt", t)
                if k % 4 == 0:
                    z.writestr("in.zip", inner.getvalue())
            out.append(held.getvalue())
        return pd.Series(out)

    bound_batches(spark)
    files = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), packed("doc_id", F.coalesce("text", F.lit(""))).alias("content"))
    members = artifacts.zip_members(files).where("member != 'in.zip'")
    checked = members.where(F.crc32("data") == F.conv(F.substring("crc32", 3, 8), 16, 10).cast("long"))
    return checked.select(F.regexp_extract("path", r"^(\d+)", 1).cast("long").alias("doc_id"), "depth", "member", "size")


@query("SELECT doc_id, source, md5(coalesce(text, '')) AS text_md5 FROM documents")
def atomic_append(spark, sf_dir):
    """Documents in two appends, the second tried twice under one name."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"), (F.col("doc_id") % 2).alias("half"))
    path = fresh_folder(spark, "atomic")
    for half, name in ((0, "even"), (1, "odd"), (1, "odd")):
        atomic.append_whole(docs.where(F.col("half") == half).drop("half"), path, name)
    return atomic.read_whole(spark, path, "doc_id long, source string, text string").select("doc_id", "source", F.md5("text").alias("text_md5"))
