"""Counts, shares, roll-ups, scores and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import rules
from textloom.functions.text import estimate_tokens
from textloom.operators.ordinals import with_ordinals


def counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def shares(rows: DataFrame, *keys: str) -> DataFrame:
    """n and percent of each key; percent is not rounded."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return counts(rows, *keys).join(F.broadcast(total)).select(*keys, "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"))


def nested_counts(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """outer, n and a map of inner to count."""
    return counts(rows, outer, inner).groupBy(outer).agg(F.sum("n").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(inner, "n")))).alias("by_inner"))


def pivot_counts(rows: DataFrame, key: str, column: str, values: list[str], total: str = "TOTAL") -> DataFrame:
    """A count per value as a column, zero-filled, with a row for all keys."""
    each = [F.coalesce(F.sum((F.col(column) == v).cast("long")), F.lit(0)).alias(v) for v in values]
    return rows.rollup(key).agg(*each, F.count(F.lit(1)).alias("total"), F.grouping(key).alias("__all")).withColumn(key, F.when(F.col("__all") == 1, total).otherwise(F.col(key))).drop("__all")


def length_stats(rows: DataFrame, text: str, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.char_length(text)).alias("avg_chars"), F.max(F.char_length(text)).alias("max_chars"))


def token_stats(rows: DataFrame, text: str, *keys: str) -> DataFrame:
    t = estimate_tokens(F.col(text))
    agg = [(F.sum(t), "tokens"), (F.avg(t), "avg_tokens"), (F.min(t), "min_tokens"), (F.max(t), "max_tokens")]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(a, F.lit(0)).alias(name) for a, name in agg])


def top(rows: DataFrame, key: str, n: int = 12) -> DataFrame:
    """The n most frequent keys; of equal counts the smaller key."""
    return counts(rows, key).orderBy(F.desc("n"), key).limit(n)


def ranked(rows: DataFrame, score: str, order: str) -> DataFrame:
    """rank by score from the highest; ties keep the given order. For per-category tables, a row each."""
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), order)))


def percent(part: Column, whole: Column, otherwise: float) -> Column:
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(otherwise))


def report_rollup(reports: DataFrame) -> DataFrame:
    """Sums of per-category reports (reviewed, accepted, improved, rejected, duplicates) and the acceptance in percent."""
    sums = reports.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("reviewed", "accepted", "improved", "rejected", "duplicates")], F.count(F.lit(1)).alias("categories"))
    return sums.withColumn("acceptance_percent", percent(F.col("accepted"), F.col("reviewed"), 100.0))


def complete_reports(reports: DataFrame, cleaned_counts: DataFrame) -> DataFrame:
    """Reports, and for categories that have none all cleaned rows as accepted with scores 8.0 and 8.5."""
    missing = cleaned_counts.join(reports, cleaned_counts["category"].eqNullSafe(reports["category"]), "left_anti")  # a null category is one, too
    assumed = missing.select("category", F.col("n").alias("reviewed"), F.col("n").alias("accepted"), *[F.lit(0).cast("long").alias(c) for c in ("improved", "rejected", "duplicates")], F.lit(8.0).alias("avg_original_score"), F.lit(8.5).alias("avg_final_score"), F.lit(False).alias("has_report"))
    return reports.withColumn("has_report", F.lit(True)).unionByName(assumed)


def mean_score(sample_score: Column, category_score: Column) -> Column:
    """Mean of positive sample scores, or else of category scores, or else 8.5."""
    return F.coalesce(F.avg(F.when(sample_score > 0, sample_score)), F.avg(category_score), F.lit(8.5))


def readiness(score: Column, accepted: Column, categories: Column, duplicates: Column, reviewed: Column) -> Column:
    """0 to 100: quality 40, volume 20, categories 20, no duplicates 20. Not rounded."""
    ratio = F.when(reviewed > 0, duplicates / reviewed).otherwise(0.0)
    return F.least(F.lit(40.0), score / 10.0 * 40.0) + F.least(F.lit(20.0), accepted / 200.0 * 20.0) + F.least(F.lit(20.0), categories / 6.0 * 20.0) + F.greatest(F.lit(0.0), F.lit(20.0) - ratio * 40.0)


def readiness_real(rows: Column, sources: Column, categories: Column, quality: float = 9.2) -> Column:
    """The variant for harvested sets; quality is a constant of the rule."""
    one = lambda x: F.least(F.lit(1.0), x)
    return F.least(F.lit(100.0), F.lit(quality / 10 * 40) + one(rows / 2000.0) * 30 + one(sources / 4.0) * 15 + one(categories / 5.0) * 15)


def keyword_coverage(text: Column, keywords: Column) -> Column:
    """Percent of keywords that occur, in any case; 100 without keywords."""
    found = F.size(F.filter(keywords, lambda k: F.contains(F.lower(text), F.lower(k))))
    return F.when(F.size(keywords) > 0, found * 100.0 / F.size(keywords)).otherwise(100.0)


def compare_runs(base: DataFrame, tuned: DataFrame, order: str, score: str) -> DataFrame:
    """Mean scores of two runs joined on the prompt's place, and their difference."""
    both = base.select(order, F.col(score).alias("base")).join(tuned.select(order, F.col(score).alias("tuned")), order)
    return both.agg(F.count(F.lit(1)).alias("n"), F.avg("base").alias("base_mean"), F.avg("tuned").alias("tuned_mean"), (F.avg("tuned") - F.avg("base")).alias("delta"))


def compare_in_order(base: DataFrame, tuned: DataFrame, order: list[str], score: str, *also: str) -> DataFrame:
    """Rows of two runs side by side by their place in the order: place, base, tuned, improvement (one decimal) and base_ and tuned_ columns of ``also``; what one run has more than the other is left out."""

    def side(rows: DataFrame, name: str) -> DataFrame:
        placed = with_ordinals(rows.select(*dict.fromkeys([score, *order, *also])), [], order, "place")
        return placed.select("place", F.col(score).cast("double").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in also])

    return side(base, "base").join(side(tuned, "tuned"), "place").withColumn("improvement", F.round(F.col("tuned") - F.col("base"), 1))


def flag_benchmark(rows: DataFrame, target: str = "target_flag", response: str = "response") -> DataFrame:
    """Rates of found flags, false positives and evidence words; the rejection rate is 100 or 0."""
    t, r = F.col(target), F.col(response)
    asked = t != rules.NOT_RECOVERED
    declined = r.contains(rules.NOT_RECOVERED) | F.lower(r).contains("not recovered")
    words = sum((F.lower(r).contains(w).cast("int") for w in rules.EVIDENCE_WORDS), F.lit(0)) * 100.0 / len(rules.EVIDENCE_WORDS)
    n = lambda c: F.count_if(c)
    total = rows.agg(F.count(F.lit(1)).alias("samples"), n(asked).alias("with_flag"), n(asked & F.contains(r, t)).alias("recovered"), n(~asked & declined).alias("rejected"), n(~asked & ~declined).alias("false_positives"), F.coalesce(F.avg(words), F.lit(0.0)).alias("evidence_percent"))
    return total.select("*", percent(F.col("recovered"), F.col("with_flag"), 0.0).alias("recovery_percent"), F.when(F.col("false_positives") == 0, 100.0).otherwise(0.0).alias("rejection_percent"), percent(F.col("false_positives"), F.col("samples"), 0.0).alias("false_positive_percent"))


def consensus(votes: DataFrame, target: str = "target", flag: str = "flag_found") -> DataFrame:
    """Per target: one distinct flag CONFIRMED, several DISAGREEMENT, none NO_FLAG_FOUND."""
    found = F.when(F.col(flag) != "", F.col(flag))
    kinds = F.count_distinct(found)
    return votes.groupBy(target).agg(F.count(found).alias("votes"), kinds.alias("flags"), F.when(kinds == 1, "CONFIRMED").when(kinds > 1, "DISAGREEMENT").otherwise("NO_FLAG_FOUND").alias("consensus"))


def winners(votes: DataFrame, target: str = "target", order: str = "ord") -> DataFrame:
    """Per target the voter of the highest confidence, then longest evidence among finders, else of the highest confidence; the first wins ties."""
    finder = F.coalesce(F.col("flag_found") != "", F.lit(False))
    rank = F.struct(finder, F.col("confidence"), F.when(finder, F.char_length("evidence_source")).otherwise(0), -F.col(order))
    return votes.groupBy(target).agg(F.max_by("model", rank).alias("winner"), F.max_by("confidence", rank).alias("confidence"))


def solver_vote(manifest_flags: Column, model: str, found: int, missing: int) -> Column:
    """A vote from the first flag of a manifest, with the solver's fixed confidences."""
    flag = F.try_element_at(manifest_flags, F.lit(1))
    return F.struct(F.lit(model).alias("model"), flag.alias("flag_found"), F.when(flag.isNotNull(), "FOUND").otherwise("NOT_FOUND").alias("status"), F.when(flag.isNotNull(), found).otherwise(missing).alias("confidence"))


def final_flag(solver: Column, planner: Column, verifier: Column) -> Column:
    """The verifier's flag, or else the solver's, or else the planner's."""
    return F.coalesce(*[F.when(c != "", c) for c in (verifier, solver, planner)])


def with_step_times(telemetry: DataFrame, total_steps: int, step: str = "step", elapsed: str = "elapsed_seconds", *keys: str) -> DataFrame:
    """Seconds per step so far, seconds left, and seconds since the row before."""
    before = F.lag(elapsed).over(Window.partitionBy(*keys).orderBy(step))
    average = F.col(elapsed) / F.nullif(F.col(step), F.lit(0))
    return telemetry.withColumns({"avg_step_seconds": average, "eta_seconds": average * F.greatest(F.lit(0), F.lit(total_steps) - F.col(step)), "delta_seconds": F.col(elapsed) - before})


def memory_pair(text: Column) -> tuple[Column, Column]:
    """Numbers of '8.20GB / 11.83GB'."""
    number = lambda k: F.regexp_extract(text, r"((?:(?<!\w)-)?[0-9.]+)\s*GB\s*/\s*(-?[0-9.]+)\s*GB", k).try_cast("double")
    return number(1), number(2)


def latest_checkpoint(names: DataFrame, name: str = "name") -> DataFrame:
    """The name with the largest numeric suffix; a name without one counts as 0."""
    suffix = F.coalesce(F.regexp_extract(name, r"-(\d+)$", 1).try_cast("long"), F.lit(0))
    return names.agg(F.max_by(name, F.struct(suffix, F.col(name))).alias("latest"), F.max(suffix).alias("step"))


def ordered_candidates(rows: DataFrame, confidence: str, text: str, n: int, *ties: str) -> DataFrame:
    """The first n by confidence from the highest, then from the shortest, then by text and the columns of ``ties``; nulls come last in confidence, first in text."""
    return rows.orderBy(F.desc(confidence), F.char_length(text), text, *ties).limit(n)
