"""Whole curation runs: the harvested-corpus pipeline and the clean-merge-grade chain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import pair_sha, triple_md5
from textloom.operators import chat, classify, dedup, filters, greedy, sampling, stats
from textloom.plans.registry import shared_folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Takes spark.checkpoint.dir; see shared_folder where that is unset."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@dataclass
class Curated:
    train: DataFrame
    val: DataFrame
    funnel: DataFrame
    leaked: DataFrame


def harvested_corpus(pairs: DataFrame, order: str, look_back: int | None = None) -> Curated:
    """pairs (order, user, assistant, category): gate, exact and near dedup, difficulty, stratified split, leakage check.

    Near dedup by clusters, unless look_back asks for the ordered greedy form.
    """
    ensure_checkpoint_dir(pairs.sparkSession)
    long = chat.long_enough(pairs)
    unique = dedup.keep_first(long.withColumn("hash", pair_sha(F.col("user"), F.col("assistant"))), F.col("hash"), [order]).checkpoint()
    text = F.concat_ws(" ", "user", "assistant")
    if look_back is None:
        kept_ids = dedup.near_clusters(unique, order, text).where("id = cluster").select(F.col("id").alias(order))
    else:
        kept_ids = greedy.near_greedy(unique, order, text, look_back=look_back).where("kept").select(F.col("id").alias(order))
    kept = unique.join(kept_ids, order, "left_semi").withColumn("difficulty", classify.difficulty_v3(F.col("user"), F.col("assistant")))
    parts = sampling.stratified_split(kept, order, "difficulty").checkpoint()
    funnel = long.agg(F.count(F.lit(1)).alias("harvested")).join(unique.agg(F.count(F.lit(1)).alias("unique_rows"))).join(parts.agg(F.count(F.lit(1)).alias("kept")))  # one row each
    train, val = parts.where("split = 'train'"), parts.where("split = 'val'")
    return Curated(train, val, funnel, dedup.leaked_keys(train, val, "hash"))


def clean_merge_grade(examples: DataFrame, order: str, category: str = "category", declared: str = "difficulty", ratio: float = 0.9) -> DataFrame:
    """examples (order, instruction, input, output): cleaned, deduplicated, split, as messages with difficulty."""
    clean = filters.clean_examples(examples)
    unique = dedup.keep_first(clean, triple_md5(F.col("instruction"), F.col("input"), F.col("output")), [order])
    graded = unique.withColumn(declared, classify.declared_or(F.col(declared), classify.difficulty_counted(F.col("instruction"), F.col("input"), F.col("output"))))
    parts = sampling.split(graded, order, ratio)
    return parts.select(order, chat.as_messages(chat.user_text(F.col("instruction"), F.col("input")), F.col("output")).alias("messages"), category, declared, "split")


def summary(rows: DataFrame) -> DataFrame:
    return stats.pivot_counts(rows, "difficulty", "split", ["train", "val"])
