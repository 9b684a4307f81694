"""Line numbers, line errors and exact places."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import stats
from textloom.plans import sqltext as S
from textloom.plans.pipelines import ensure_checkpoint_dir
from textloom.plans.registry import fresh_folder, query, read
from textloom.sources import jsonl, lines


def _line_files(spark, sf_dir, *folders):
    """Files of JSON lines in the order of doc_id, a blank line after every fifth; some lines lack a key, hold a null or a number, or are no JSON."""
    ensure_checkpoint_dir(spark)
    n = F.col("doc_id") % 7
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(F.coalesce(c, F.lit("")))), r"(?s)^\[(.*)\]$", 1)
    values = {"instruction": F.when(n == 4, "17").otherwise(quoted("lang")), "input": F.when(n != 1, '""'), "output": F.when(n == 2, "null").otherwise(quoted("text"))}
    record = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{c}":'), v) for c, v in values.items()]), F.lit("}"))
    line = F.concat(F.when(n == 3, "not ").otherwise(""), record, F.when(F.col("doc_id") % 5 == 1, "\n").otherwise(""))
    rows = read(spark, sf_dir, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(line.alias("value"), *folders)
    path = fresh_folder(spark, "lines")
    (rows.write.partitionBy(*folders) if folders else rows.write).text(path)
    return path


_KEPT = "CASE WHEN doc_id % 7 = 4 THEN '17' ELSE coalesce(lang, '') END || CASE WHEN doc_id % 7 = 2 THEN '' ELSE coalesce(text, '') END"
_PLACES = f"SELECT doc_id, lang, text, (sum(1 + (doc_id % 5 = 1)::INT) OVER (ORDER BY doc_id) - (doc_id % 5 = 1)::INT)::BIGINT AS line_number, CASE WHEN doc_id % 7 <> 3 THEN md5({_KEPT}) END AS hash FROM documents"


@query(f"SELECT line_number, md5(CASE WHEN doc_id % 7 = 3 THEN 'not ' ELSE '' END) AS opening FROM ({_PLACES}) UNION ALL SELECT line_number + 1, NULL FROM ({_PLACES}) WHERE doc_id % 5 = 1")
def line_numbers(spark, sf_dir):
    """Numbers of all lines over all files, blank ones too, with a digest of what stands before the brace."""
    found = lines.numbered_lines(spark, _line_files(spark, sf_dir), across=True)
    return found.select("line_number", F.when(F.col("line") != "", F.md5(F.regexp_extract("line", r"^[^{]*", 0))).alias("opening"))


@query(f"""
SELECT line_number, array_to_string(list_filter(CASE WHEN hash IS NULL THEN ['Invalid JSON'] ELSE [
  CASE WHEN doc_id % 7 = 4 THEN 'Field ''instruction'' is no text' WHEN {S.strip("coalesce(lang, '')")} = '' THEN 'Empty field ''instruction''' END, CASE WHEN doc_id % 7 = 1 THEN 'Missing field ''input''' ELSE 'Empty field ''input''' END,
  CASE WHEN doc_id % 7 = 2 OR {S.strip("coalesce(text, '')")} = '' THEN 'Empty field ''output''' END, CASE WHEN line_number > first THEN 'Duplicate content (hash: ' || hash[1:8] || ')' END,
  CASE WHEN doc_id % 7 <> 2 AND contains(text, '```') THEN 'Contains markdown code fences' END] END, lambda e: e IS NOT NULL), '; ') AS errors
FROM (SELECT *, min(line_number) OVER (PARTITION BY hash) AS first FROM ({_PLACES}))
""")
def line_errors(spark, sf_dir):
    """Errors of each line under its number over all files, content repeated anywhere among them."""
    checked = lines.checked_lines(lines.numbered_lines(spark, _line_files(spark, sf_dir), across=True))
    return lines.errors_of(lines.with_repeats(checked, by=())).select("line_number", F.array_join("errors", "; ").alias("errors"))


@query("SELECT 'source=' || coalesce(source, '__HIVE_DEFAULT_PARTITION__') AS folder, count(*) AS lines, count(*) FILTER (doc_id % 7 <> 3) AS valid FROM documents GROUP BY source")
def folder_validation(spark, sf_dir):
    checked = lines.checked_lines(lines.numbered_lines(spark, f"{_line_files(spark, sf_dir, 'source')}/*/"))
    return lines.folder_summary(lines.with_repeats(checked), jsonl.parent_folder(F.col("file"))).drop("files", "duplicates")


_SIDE = "SELECT row_number() OVER (ORDER BY doc_id) AS place, length(text)::DOUBLE AS score, doc_id FROM documents WHERE coalesce(lang, '') {} 'en'"


@query(f"SELECT place, b.score AS base, t.score AS tuned, b.doc_id AS base_doc_id, t.doc_id AS tuned_doc_id, round(t.score - b.score, 1) AS improvement FROM ({_SIDE.format('=')}) b JOIN ({_SIDE.format('<>')}) t USING (place)")
def runs_in_order(spark, sf_dir):
    """Two runs of different length zipped by place, without a task that holds a run."""
    ensure_checkpoint_dir(spark)
    rows = read(spark, sf_dir, "documents").select("doc_id", F.char_length("text").alias("score"), F.coalesce("lang", F.lit("")).alias("lang"))
    return stats.compare_in_order(rows.where("lang = 'en'"), rows.where("lang <> 'en'"), ["doc_id"], "score", "doc_id")
