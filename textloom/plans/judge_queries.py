"""Scores by a judge that is a plain function of a text's length, so that SQL can follow it."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from textloom.functions.text import triple_md5
from textloom.operators import judge
from textloom.plans import sqltext as S
from textloom.plans.pipelines import ensure_checkpoint_dir
from textloom.plans.registry import fresh_folder, query, read

MODELS = ["small", "large"]


def graded(examples: list[dict], model: str) -> list[str]:
    """Answers in JSON, some fenced or wrapped in words, some of no use; the small model's quota ends at every eleventh length."""
    lengths = [len(x["output"]) for x in examples]
    if model == "small" and any(n % 11 == 0 for n in lengths):
        raise RuntimeError("429: quota")
    found = []
    for n in lengths:
        answer = {"score": n % 101 / 10, "suggestion": f" say {n % 3} more "}
        answer |= {"quality": "Bad"} if n % 17 == 0 else {}
        answer |= {"issues": ["too short", "no source"]} if n % 5 == 0 else {"issues": "vague"} if n % 5 == 1 else {}
        answer |= {"difficulty": "Expert"} if n % 4 == 0 else {"difficulty": "unsure"} if n % 4 == 1 else {}
        text = json.dumps(answer)
        found.append("no idea" if n % 13 == 0 else f"```json\n{text}\n```" if n % 3 == 0 else f"I find: {text}" if n % 3 == 1 else text)
    return found


def amended(examples: list[dict], model: str) -> list[str]:
    return ["sorry" if len(x["output"]) % 6 == 0 else json.dumps({"instruction": x["instruction"], "output": x["output"] + " Checked. "}) for x in examples]


def _examples(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return read(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("instruction"), F.lit("").alias("input"), F.coalesce("text", F.lit("")).alias("output"))


def _judge(spark, tag="verdicts", **options):
    return judge.Judge(spark, fresh_folder(spark, tag), graded, MODELS, pause=0.0, batch_rows=256, **options)


def _score(n: str) -> str:
    return f"CASE WHEN {n} % 13 = 0 THEN 5.0::DOUBLE ELSE round({n} % 101 / 10.0::DOUBLE, 1) END"


def _good(n: str) -> str:
    return f"({n} % 13 <> 0 AND {n} % 17 <> 0 AND {n} % 101 >= 70)"


def _level(n: str) -> str:
    return f"CASE WHEN {n} % 13 = 0 THEN NULL WHEN {n} % 4 = 0 THEN 'expert' WHEN {n} % 4 > 1 THEN 'intermediate' WHEN {n} % 101 >= 90 THEN 'advanced' WHEN {n} % 101 >= 70 THEN 'intermediate' ELSE 'beginner' END"


def _issues(n: str) -> str:
    return f"CASE WHEN {n} % 13 = 0 OR {n} % 5 = 1 THEN 1 WHEN {n} % 5 = 0 THEN 2 ELSE 0 END"


KINDS = f"SELECT hash, min(doc_id) AS first, any_value(o) AS o, any_value(length({S.strip('o')})) AS n FROM (SELECT doc_id, coalesce(text, '') AS o, md5(coalesce(lang, '') || coalesce(text, '')) AS hash FROM documents) GROUP BY hash"


@query(f"SELECT hash, 1::BIGINT AS times_stored, {_score('n')} AS score, CASE WHEN {_good('n')} THEN 'good' ELSE 'bad' END AS quality, {_level('n')} AS difficulty, {_issues('n')} AS n_issues, n % 13 <> 0 AS answered FROM ({KINDS})")
def judge_resume(spark, sf_dir):
    """A store that a first run over part of the rows has filled, gone on from by a run over all of them: no content is stored twice."""
    rows = _examples(spark, sf_dir).withColumn("hash", triple_md5(F.col("instruction"), F.col("input"), F.col("output")))
    own = _judge(spark)
    for part in (rows.where("doc_id % 2 = 0"), rows):
        own.scored(part.select("hash", *judge.FIELDS))
    return own.store.stored().groupBy(F.col("key").alias("hash")).agg(F.count(F.lit(1)).alias("times_stored"), *[F.first(c).alias(c) for c in ("score", "quality", "difficulty")], F.size(F.first("issues")).alias("n_issues"), F.first("answered").alias("answered"))


_M = "CASE WHEN n % 6 = 0 THEN n ELSE n + 9 END"
_TAKEN = "(direct OR (improved AND n % 6 = 0)) AND d.doc_id > first"  # a rewrite of other words takes its own words


@query(f"""
WITH k AS (SELECT *, {_score('n')} AS score, {_good('n')} AS direct, {_M} AS m FROM ({KINDS})),
j AS (SELECT *, NOT direct AND (score >= 3 OR {_issues('n')} > 0) AS weak, {_score('m')} AS re_score FROM k),
f AS (SELECT *, weak AND (re_score >= 7 OR re_score > score) AS improved FROM j),
d AS (SELECT doc_id, md5(coalesce(lang, '') || coalesce(text, '')) AS hash FROM documents),
s AS (SELECT d.doc_id, f.*, CASE WHEN {_TAKEN} THEN 'duplicate' WHEN direct THEN 'accepted' WHEN improved THEN 'improved' ELSE 'rejected' END AS status FROM d JOIN f ON f.hash = d.hash)
SELECT doc_id, status, CASE WHEN status = 'duplicate' THEN 0 ELSE score END AS original_score, CASE WHEN status = 'duplicate' THEN 0 WHEN weak THEN re_score ELSE score END AS final_score,
  CASE WHEN status <> 'duplicate' THEN coalesce(CASE WHEN weak THEN {_level('m')} END, {_level('n')}, 'intermediate') END AS final_difficulty,
  CASE WHEN status = 'duplicate' THEN 1 ELSE {_issues('n')} END AS n_issues, CASE status WHEN 'accepted' THEN 1 WHEN 'improved' THEN 2 ELSE 0 END AS n_improvements,
  CASE status WHEN 'accepted' THEN md5(o) WHEN 'improved' THEN md5(CASE WHEN n % 6 = 0 THEN o ELSE {S.strip('o')} || ' Checked.' END) END AS kept_md5
FROM s
""")
def judge_review(spark, sf_dir):
    """Duplicates, verdicts, rewrites and second verdicts of all documents, in the order of doc_id."""
    rewriter = judge.Rewriter(spark, fresh_folder(spark, "rewrites"), amended, ["one"], retries=1, pause=0.0, batch_rows=256)
    found = judge.reviewed(_examples(spark, sf_dir), "doc_id", _judge(spark), rewriter)
    return found.select("doc_id", "status", "original_score", "final_score", "final_difficulty", F.size("issues").alias("n_issues"), F.size("improvements").alias("n_improvements"), F.md5("kept_output").alias("kept_md5"))
