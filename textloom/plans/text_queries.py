"""Normalisation, token, filter and classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import classify, filters, stats
from textloom.operators.chat import row_id
from textloom.operators.dedup import funnel, keep_first
from textloom.operators.ordinals import with_ordinals
from textloom.plans import sqltext as S
from textloom.plans.pipelines import ensure_checkpoint_dir
from textloom.plans.registry import query, read


@query(f"""
WITH kept AS (SELECT sha256({S.fold("text")}) AS h, arg_min(lang, doc_id) AS lang FROM documents GROUP BY 1)
SELECT lang, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM kept)::DOUBLE AS percent FROM kept GROUP BY lang
""")
def dedup_language_share(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return stats.shares(keep_first(docs, F.sha2(X.normalize_fold(F.col("text")), 256), ["doc_id"]), "lang")


@query(f"SELECT doc_id, {S.clean('text')} AS clean_text FROM documents")
def normalize_clean(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", X.normalize_clean(F.col("text")).alias("clean_text"))


@query(f"SELECT doc_id, {S.fold('text')} AS folded FROM documents")
def normalize_fold(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", X.normalize_fold(F.col("text")).alias("folded"))


@query(f"SELECT page_id, {S.markdown('html')} AS cleaned FROM pages")
def markdown_clean(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", X.clean_markdown(F.col("html")).alias("cleaned"))


@query(f"SELECT doc_id, {S.tokens('text')} AS tokens, greatest(length(text) // 4, 1)::INT AS manifest_tokens FROM documents")
def token_estimate(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", X.estimate_tokens(F.col("text")).alias("tokens"), X.manifest_tokens(F.col("text")).alias("manifest_tokens"))


@query(f"SELECT conv_id, {S.tokens(chr(34) + 'user' + chr(34))} + {S.tokens('assistant')} AS tokens FROM ({S.PAIRS}) WHERE {S.tokens(chr(34) + 'user' + chr(34))} + {S.tokens('assistant')} BETWEEN 15 AND 2048")
def token_window_filter(spark, sf_dir):
    from textloom.operators.chat import last_pair

    pairs = filters.within_token_window(last_pair(read(spark, sf_dir, "conversations")))
    return pairs.select("conv_id", (X.estimate_tokens(F.col("user")) + X.estimate_tokens(F.col("assistant"))).alias("tokens"))


@query(f"SELECT lang, count(*) AS n, sum({S.tokens('text')})::BIGINT AS tokens, avg({S.tokens('text')}) AS avg_tokens, min({S.tokens('text')}) AS min_tokens, max({S.tokens('text')}) AS max_tokens FROM documents GROUP BY lang")
def token_stats(spark, sf_dir):
    return stats.token_stats(read(spark, sf_dir, "documents"), "text", "lang")


@query("SELECT source, count(*) AS n, avg(length(text)) AS avg_chars, max(length(text)) AS max_chars FROM documents GROUP BY source")
def length_stats(spark, sf_dir):
    return stats.length_stats(read(spark, sf_dir, "documents"), "text", "source")


@query(f"SELECT doc_id, {S.alpha('text')} AS alpha FROM documents")
def alpha_ratio(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", X.alpha_ratio(F.col("text")).alias("alpha"))


@query("SELECT doc_id, " + ", ".join(f"{S.low_quality('text', f)} AS bad_{f}" for f in ("instruction", "input", "output")) + " FROM documents")
def low_quality_filter(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", *[filters.is_low_quality(F.col("text"), f).alias(f"bad_{f}") for f in ("instruction", "input", "output")])


@query(f"""
WITH clean AS (SELECT source, doc_id, {S.clean("text")} AS t FROM documents),
good AS (SELECT * FROM clean WHERE NOT {S.low_quality("t", "output")}),
first AS (SELECT source, row_number() OVER (PARTITION BY md5(t) ORDER BY doc_id) AS nth FROM good),
total AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
norm AS (SELECT source, count(*) AS normalised, count(*) FILTER (nth = 1) AS uniq FROM first GROUP BY source),
each AS (SELECT t.source, t.total, coalesce(n.normalised, 0) AS normalised, coalesce(n.uniq, 0) AS uniq FROM total t LEFT JOIN norm n ON n.source = t.source)
SELECT source, total, normalised, uniq, total - uniq AS removed FROM each
UNION ALL SELECT 'TOTAL', sum(total)::BIGINT, sum(normalised)::BIGINT, sum(uniq)::BIGINT, sum(total - uniq)::BIGINT FROM each
""")
def clean_funnel(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", X.normalize_clean(F.col("text")).alias("t"))
    found = funnel(docs, "source", ~filters.is_low_quality(F.col("t"), "output"), F.md5("t"), "doc_id")
    return found.select(F.when(F.col("is_total"), "TOTAL").otherwise(F.col("source")).alias("source"), "total", "normalised", "uniq", "removed")


@query(f"SELECT doc_id, list_sort({S.word_set('text')}) AS words FROM documents")
def word_tokens(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.array_sort(X.word_set(F.col("text"))).alias("words"))


@query(f"SELECT conv_id, {S.v3(chr(34) + 'user' + chr(34), 'assistant')} AS difficulty FROM ({S.PAIRS})")
def difficulty_v3(spark, sf_dir):
    from textloom.operators.chat import last_pair

    return last_pair(read(spark, sf_dir, "conversations")).select("conv_id", classify.difficulty_v3(F.col("user"), F.col("assistant")).alias("difficulty"))


@query(f"SELECT conv_id, {S.v2(chr(34) + 'user' + chr(34), 'assistant')} AS difficulty FROM ({S.PAIRS})")
def difficulty_v2(spark, sf_dir):
    from textloom.operators.chat import last_pair

    return last_pair(read(spark, sf_dir, "conversations")).select("conv_id", classify.difficulty_v2(F.col("user"), F.col("assistant")).alias("difficulty"))


@query(f"SELECT doc_id, {S.counted(['source', 'lang', 'text'])} AS difficulty FROM documents")
def difficulty_counts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", classify.difficulty_counted(F.col("source"), F.col("lang"), F.col("text")).alias("difficulty"))


@query("SELECT doc_id, CASE WHEN lower(lang) = 'en' THEN 'expert' WHEN length(text) > 300 THEN 'intermediate' ELSE 'beginner' END AS difficulty FROM documents")
def declared_difficulty(spark, sf_dir):
    declared = F.when(F.col("lang") == "en", F.lit(" Expert ")).otherwise(F.col("lang"))
    return read(spark, sf_dir, "documents").select("doc_id", classify.declared_or(declared, F.when(F.char_length("text") > 300, "intermediate").otherwise("beginner")).alias("difficulty"))


@query(f"SELECT page_id, {S.category('url')} AS category FROM pages")
def category_normalize(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", classify.normalize_category(F.col("url")).alias("category"))


@query("""
SELECT event_id, least(10.0, greatest(0.0, value)) AS score,
  CASE WHEN least(10.0, greatest(0.0, value)) >= 7 THEN 'good' ELSE 'bad' END AS quality,
  CASE WHEN value >= 9 THEN 'advanced' WHEN value >= 7 THEN 'intermediate' ELSE 'beginner' END AS difficulty,
  CASE WHEN value >= 80 THEN 'READY FOR PRODUCTION TRAINING' WHEN value >= 65 THEN 'READY (RECOMMENDED MINOR EXPANSION)' ELSE 'NEEDS REVISION' END AS readiness
FROM events
""")
def score_labels(spark, sf_dir):
    value = F.col("value")
    return read(spark, sf_dir, "events").select("event_id", classify.clamp_score(value).alias("score"), classify.score_quality(value, F.lit("unknown")).alias("quality"), classify.score_difficulty(value).alias("difficulty"), classify.readiness_label(value).alias("readiness"))


@query("SELECT doc_id, source || '_' || lpad((row_number() OVER (PARTITION BY source ORDER BY doc_id))::VARCHAR, 4, '0') AS row_id, text[1:80] AS preview FROM documents")
def row_ids(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    previews = read(spark, sf_dir, "documents").select("doc_id", "source", X.preview(F.col("text"), 80).alias("preview"))
    numbered = with_ordinals(previews, ["source"], ["doc_id"], "nth")
    return numbered.select("doc_id", row_id(F.col("source"), F.col("nth")).alias("row_id"), "preview")


@query("""
WITH t AS (SELECT event_id, '{"score": ' || value || ', "kind": "' || event_type || '"}' AS j FROM events)
SELECT event_id, json_extract_string(j, '$.kind') AS kind FROM t
""")
def json_answers(spark, sf_dir):
    inner = F.concat(F.lit('{"score": '), F.col("value").cast("string"), F.lit(', "kind": "'), "event_type", F.lit('"}'))
    answer = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("```json\n"), inner, F.lit("\n```"))).otherwise(F.concat(F.lit("Here it is: "), inner, F.lit(" as asked")))
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object(X.extract_json(answer), "$.kind").alias("kind"))
