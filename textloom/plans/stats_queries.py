"""Aggregates, scores, votes and telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import rules
from textloom.operators import filters, stats
from textloom.plans import sqltext as S
from textloom.plans.registry import query, read
from textloom.plans.sampling_queries import tiered


@query("SELECT lang, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents)::DOUBLE AS percent FROM documents GROUP BY lang")
def share_of_total(spark, sf_dir):
    return stats.shares(read(spark, sf_dir, "documents"), "lang")


@query(f"""
WITH s AS (SELECT tier, CASE WHEN row_number() OVER (PARTITION BY tier ORDER BY {S.order_key('doc_id')}, doc_id) <= greatest(1, floor(count(*) OVER (PARTITION BY tier) * 0.1::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM {S.TIERS})
SELECT tier, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) AS total FROM s GROUP BY tier
UNION ALL SELECT 'TOTAL', count(*) FILTER (split = 'train'), count(*) FILTER (split = 'val'), count(*) FROM s
""")
def tier_pivot(spark, sf_dir):
    from textloom.operators.sampling import stratified_split

    return stats.pivot_counts(stratified_split(tiered(spark, sf_dir), "doc_id", "tier"), "tier", "split", ["train", "val"])


@query(f"SELECT tier, sum(n)::BIGINT AS n, string_agg(lang || '=' || n, ',' ORDER BY lang) AS langs FROM (SELECT tier, lang, count(*) AS n FROM {S.TIERS} GROUP BY tier, lang) GROUP BY tier")
def nested_counts(spark, sf_dir):
    rows = stats.nested_counts(tiered(spark, sf_dir), "tier", "lang")
    pairs = F.transform(F.array_sort(F.map_entries("by_inner")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return rows.select("tier", "n", F.array_join(pairs, ",").alias("langs"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 12")
def top_categories(spark, sf_dir):
    return stats.top(read(spark, sf_dir, "documents"), "source")


@query("SELECT source, score, row_number() OVER (ORDER BY score DESC, source) AS rank FROM (SELECT source, max(length(text)) AS score FROM documents GROUP BY source)")
def rank_categories(spark, sf_dir):
    scores = read(spark, sf_dir, "documents").groupBy("source").agg(F.max(F.char_length("text")).alias("score"))
    return stats.ranked(scores, "score", "source")


SCORED = "(SELECT d.doc_id, d.source, CASE WHEN l.quality = 1 THEN 7.0 + l.doc_id % 4 ELSE l.doc_id % 7 END::DOUBLE AS score, CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS quality, l.toxic FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"


def _scored(spark, sf_dir):
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    good = F.col("quality") == 1
    score = F.when(good, F.lit(7.0) + F.col("doc_id") % 4).otherwise(F.col("doc_id") % 7).cast("double")
    return rows.select("doc_id", "source", score.alias("score"), F.when(good, "good").otherwise("bad").alias("quality"), "toxic")


@query(f"""
SELECT doc_id, score >= 7 AND quality = 'good' AS accepted, score >= 3 OR toxic = 1 AS improvable, score >= 4 OR toxic = 1 AS improvable_real, score + 1 >= 7 OR score + 1 > score AS accepted_again FROM {SCORED}
""")
def score_gate(spark, sf_dir):
    score, issues = F.col("score"), F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>"))
    return _scored(spark, sf_dir).select(
        "doc_id", filters.accepted(score, F.col("quality")).alias("accepted"), filters.to_improve(score, issues, 3.0).alias("improvable"), filters.to_improve(score, issues, 4.0).alias("improvable_real"), filters.accepted_again(score + 1, score).alias("accepted_again")
    )


REPORTS = f"(SELECT source AS category, count(*) AS reviewed, count(*) FILTER (quality = 'good') AS accepted, count(*) FILTER (toxic = 1) AS improved, count(*) FILTER (quality = 'bad') AS rejected, 0::BIGINT AS duplicates, avg(score) AS avg_original_score, avg(score) AS avg_final_score FROM {SCORED} GROUP BY source)"


def _reports(spark, sf_dir):
    good = F.col("quality") == "good"
    return _scored(spark, sf_dir).groupBy(F.col("source").alias("category")).agg(
        F.count(F.lit(1)).alias("reviewed"), F.count_if(good).alias("accepted"), F.count_if(F.col("toxic") == 1).alias("improved"), F.count_if(~good).alias("rejected"), F.lit(0).cast("long").alias("duplicates"), F.avg("score").alias("avg_original_score"), F.avg("score").alias("avg_final_score")
    )


@query(f"SELECT sum(reviewed)::BIGINT AS reviewed, sum(accepted)::BIGINT AS accepted, sum(improved)::BIGINT AS improved, sum(rejected)::BIGINT AS rejected, sum(duplicates)::BIGINT AS duplicates, count(*) AS categories, sum(accepted)::BIGINT * 100.0::DOUBLE / sum(reviewed)::BIGINT AS acceptance_percent FROM {REPORTS}")
def report_rollup(spark, sf_dir):
    return stats.report_rollup(_reports(spark, sf_dir))


@query(f"""
SELECT category, reviewed, accepted, avg_final_score, true AS has_report FROM {REPORTS}
UNION ALL SELECT source, count(*), count(*), 8.5::DOUBLE, false FROM documents d WHERE NOT EXISTS (SELECT 1 FROM {REPORTS} r WHERE r.category IS NOT DISTINCT FROM d.source) GROUP BY source
""")
def report_completion(spark, sf_dir):
    cleaned = read(spark, sf_dir, "documents").groupBy(F.col("source").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return stats.complete_reports(_reports(spark, sf_dir), cleaned).select("category", "reviewed", "accepted", "avg_final_score", "has_report")


@query(f"""
WITH t AS (SELECT (SELECT avg(score) FROM {SCORED} WHERE score > 0) AS s, sum(accepted)::BIGINT AS a, count(*) AS c, sum(duplicates)::BIGINT AS d, sum(reviewed)::BIGINT AS r FROM {REPORTS})
SELECT s AS mean_score, least(40.0::DOUBLE, s / 10.0 * 40.0) + least(20.0::DOUBLE, a / 200.0::DOUBLE * 20.0) + least(20.0::DOUBLE, c / 6.0::DOUBLE * 20.0) + greatest(0.0::DOUBLE, 20.0 - d / r::DOUBLE * 40.0) AS readiness FROM t
""")
def readiness_score(spark, sf_dir):
    mean = _scored(spark, sf_dir).agg(stats.mean_score(F.col("score"), F.lit(None).cast("double")).alias("mean_score"))
    sums = stats.report_rollup(_reports(spark, sf_dir))
    both = sums.join(F.broadcast(mean))  # one row each
    return both.select("mean_score", stats.readiness(F.col("mean_score"), F.col("accepted"), F.col("categories"), F.col("duplicates"), F.col("reviewed")).alias("readiness"))


@query("SELECT least(100.0::DOUBLE, 36.8::DOUBLE + least(1.0::DOUBLE, count(*) / 2000.0::DOUBLE) * 30 + least(1.0::DOUBLE, count(DISTINCT source) / 4.0::DOUBLE) * 15 + least(1.0::DOUBLE, count(DISTINCT lang) / 5.0::DOUBLE) * 15) AS readiness FROM documents")
def readiness_real(spark, sf_dir):
    n = read(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("s"), F.count_distinct("lang").alias("c"))
    return n.select(stats.readiness_real(F.col("n"), F.col("s"), F.col("c")).alias("readiness"))


@query("SELECT doc_id, (contains(lower(text), 'the')::INT + contains(lower(text), 'license')::INT + contains(lower(text), 'token')::INT) * 100.0::DOUBLE / 3 AS coverage FROM documents")
def keyword_coverage(spark, sf_dir):
    words = F.array(F.lit("The"), F.lit("license"), F.lit("TOKEN"))
    return read(spark, sf_dir, "documents").select("doc_id", stats.keyword_coverage(F.col("text"), words).alias("coverage"))


@query("SELECT count(*) AS n, avg(length(b.text)) AS base_mean, avg(length(d.text)) AS tuned_mean, avg(length(d.text)) - avg(length(b.text)) AS delta FROM benchmark b JOIN documents d ON d.doc_id = b.item_id")
def base_vs_tuned(spark, sf_dir):
    base = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ord"), F.char_length("text").alias("score"))
    tuned = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.char_length("text").alias("score"))
    return stats.compare_runs(base, tuned, "ord", "score")


TARGETS = f"(SELECT CASE WHEN doc_id % 3 = 0 THEN '{rules.NOT_RECOVERED}' ELSE source END AS t, CASE WHEN doc_id % 2 = 0 THEN source || ' evidence file' ELSE 'was not recovered' END AS r FROM documents)"


@query(f"""
SELECT *, recovered * 100.0::DOUBLE / with_flag AS recovery_percent, CASE WHEN false_positives = 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS rejection_percent, false_positives * 100.0::DOUBLE / samples AS false_positive_percent
FROM (SELECT count(*) AS samples, count(*) FILTER (t <> '{rules.NOT_RECOVERED}') AS with_flag, count(*) FILTER (t <> '{rules.NOT_RECOVERED}' AND contains(r, t)) AS recovered,
  count(*) FILTER (t = '{rules.NOT_RECOVERED}' AND contains(r, 'not recovered')) AS rejected, count(*) FILTER (t = '{rules.NOT_RECOVERED}' AND NOT contains(r, 'not recovered')) AS false_positives,
  avg((contains(r, 'evidence')::INT + contains(r, 'file')::INT) * 100.0::DOUBLE / 7) AS evidence_percent FROM {TARGETS})
""")
def flag_benchmark(spark, sf_dir):
    n = F.col("doc_id")
    rows = read(spark, sf_dir, "documents").select(F.when(n % 3 == 0, rules.NOT_RECOVERED).otherwise(F.col("source")).alias("target_flag"), F.when(n % 2 == 0, F.concat("source", F.lit(" evidence file"))).otherwise("was not recovered").alias("response"))
    return stats.flag_benchmark(rows)


VOTES = "(SELECT user_id AS target, event_id AS ord, event_type AS model, CASE WHEN value > 20 THEN 'FLAG{' || event_type || '}' END AS flag_found, floor(value)::INT % 100 AS confidence, props AS evidence_source FROM events)"


def _votes(spark, sf_dir):
    flag = F.when(F.col("value") > 20, F.concat(F.lit("FLAG{"), "event_type", F.lit("}")))
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("target"), F.col("event_id").alias("ord"), F.col("event_type").alias("model"), flag.alias("flag_found"), (F.floor("value").cast("int") % 100).alias("confidence"), F.col("props").alias("evidence_source"))


@query(f"SELECT target, count(flag_found) AS votes, count(DISTINCT flag_found) AS flags, CASE count(DISTINCT flag_found) WHEN 0 THEN 'NO_FLAG_FOUND' WHEN 1 THEN 'CONFIRMED' ELSE 'DISAGREEMENT' END AS consensus FROM {VOTES} GROUP BY target")
def consensus_vote(spark, sf_dir):
    return stats.consensus(_votes(spark, sf_dir))


@query(f"""
SELECT target, model AS winner, confidence FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY flag_found IS NOT NULL DESC, confidence DESC, CASE WHEN flag_found IS NOT NULL THEN length(evidence_source) ELSE 0 END DESC, ord) AS nth FROM {VOTES}) WHERE nth = 1
""")
def vote_winner(spark, sf_dir):
    return stats.winners(_votes(spark, sf_dir))


@query("""
SELECT event_id, CASE WHEN value > 50 THEN 'v' WHEN value > 20 THEN 's' WHEN value > 10 THEN 'p' END AS flag, CASE WHEN value > 20 THEN 98 ELSE 20 END AS confidence, CASE WHEN value > 20 THEN 'FOUND' ELSE 'NOT_FOUND' END AS status FROM events
""")
def flag_precedence(spark, sf_dir):
    value = F.col("value")
    final = stats.final_flag(F.when(value > 20, "s"), F.when(value > 10, "p"), F.when(value > 50, "v"))
    vote = stats.solver_vote(F.when(value > 20, F.array(F.lit("FLAG{x}"))).otherwise(F.array().cast("array<string>")), "local", 98, 20)
    return read(spark, sf_dir, "events").select("event_id", final.alias("flag"), vote["confidence"].alias("confidence"), vote["status"].alias("status"))


@query("""
SELECT user_id, event_id, value, avg_step_seconds, eta_seconds, delta_seconds FROM (
  SELECT user_id, event_id, value, value / nullif(event_id, 0) AS avg_step_seconds, value / nullif(event_id, 0) * greatest(0, 20000 - event_id) AS eta_seconds, value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS delta_seconds FROM events)
""")
def telemetry_delta(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return stats.with_step_times(events, 20000, "event_id", "value", "user_id")


@query("SELECT event_id, value AS used, value + 1 AS reserved FROM events")
def telemetry_parse(spark, sf_dir):
    used, reserved = stats.memory_pair(F.concat(F.col("value").cast("decimal(18,6)").cast("string"), F.lit("GB / "), (F.col("value") + 1).cast("decimal(18,6)").cast("string"), F.lit("GB")))
    return read(spark, sf_dir, "events").select("event_id", used.alias("used"), reserved.alias("reserved"))


@query("SELECT 'checkpoint-' || max(o_orderkey) AS latest, max(o_orderkey) AS step FROM orders")
def latest_checkpoint(spark, sf_dir):
    return stats.latest_checkpoint(read(spark, sf_dir, "orders").select(F.concat(F.lit("checkpoint-"), F.col("o_orderkey").cast("string")).alias("name")))


@query("SELECT p_partkey, p_size, p_name FROM part ORDER BY p_size DESC, length(p_name), p_name, p_partkey LIMIT 25")
def ordered_candidates(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    return stats.ordered_candidates(parts, "p_size", "p_name", 25, "p_partkey")
