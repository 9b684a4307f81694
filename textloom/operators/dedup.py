"""Exact and near dedup, audits and leakage checks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import rules
from textloom.functions.text import word_set
from textloom.operators.batches import bound_batches
from textloom.operators.components import smallest_reached

#: The commonest words whose frequencies are broadcast, twelve bytes or so each; it sets the order of words, not the result.
FREQUENT = 1 << 16
#: From this threshold on sets meet by parts of five words or more; below it parts are too small to tell sets apart.
PARTS_FROM = 0.85
ODD, ODD_TOO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def keep_first(rows: DataFrame, key: Column, order: list) -> DataFrame:
    """The first row of each key by order; every column stays. Ranks are limited before the shuffle."""
    first = Window.partitionBy("__key").orderBy(*order)
    return rows.withColumn("__key", key).withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__key", "__nth")


def funnel(rows: DataFrame, group: str, kept: Column, key: Column, order: str) -> DataFrame:
    """Per group, and in a row with is_total: total, normalised (kept rows), uniq (those that are the first of their key by ``order``), removed.

    rows is read once: what is counted by group and key is all that goes on, so a key that a third of the
    rows share is as many rows as it has groups.
    """
    counted = rows.select(F.col(group), F.coalesce(kept, F.lit(False)).alias("kept"), key.alias("key"), F.col(order).alias("order"))
    counted = counted.withColumn("key", F.when(F.col("kept"), F.col("key"))).groupBy(group, "kept", "key").agg(F.count(F.lit(1)).alias("n"), F.min("order").alias("first"))
    leads = F.row_number().over(Window.partitionBy("kept", "key").orderBy(F.asc_nulls_last("first"), group)) == 1  # a row a group and key
    counted = counted.withColumn("leads", F.col("kept") & leads)
    sums = counted.rollup(group).agg(F.sum("n").alias("total"), F.sum(F.when(F.col("kept"), F.col("n")).otherwise(0)).alias("normalised"), F.count_if("leads").alias("uniq"), (F.grouping(group) == 1).alias("is_total"))
    return sums.withColumn("removed", F.col("total") - F.col("uniq"))


def duplicate_examples(rows: DataFrame, id_col: str, key: Column, n: int = 5) -> DataFrame:
    """id, key, nth, copies of the first n rows, by id, that repeat an earlier one; only the keys of those are looked at for their place."""
    slim = rows.select(F.col(id_col).alias("id"), key.alias("key")).checkpoint()
    repeated = slim.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("lead")).where("copies > 1")
    chosen = slim.join(repeated, "key").where("id > lead").select("id", "key", "copies").orderBy("id").limit(n).checkpoint()
    wanted = F.broadcast(chosen.select(F.col("key").alias("__key"), F.col("id").alias("__id"), "copies"))  # n rows
    before = slim.join(wanted, (F.col("key") == F.col("__key")) & (F.col("id") <= F.col("__id")))
    return before.groupBy(F.col("__id").alias("id"), "key", "copies").agg(F.count(F.lit(1)).alias("nth")).select("id", "key", "nth", "copies")


def accept_then_keep_first(rows: DataFrame, accept: Column, key: Column, order: list) -> DataFrame:
    """Rejected rows never claim a key: only accepted ones are deduplicated."""
    return keep_first(rows.where(accept), key, order)


def duplicate_audit(rows: DataFrame, key: Column, *groups: str) -> DataFrame:
    """total, distinct and duplicate counts, by groups if any."""
    counts = rows.select(*groups, key.alias("__key")).groupBy(*groups, "__key").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*groups).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("unique_keys"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def leaked_keys(train: DataFrame, held_out: DataFrame, key: str) -> DataFrame:
    return train.select(key).intersect(held_out.select(key))


def _word_classes(rows: DataFrame, id_col: str, text: Column) -> tuple[DataFrame, DataFrame]:
    """Rows (id, first) with the smallest id of their equal word sets, null without words; and the distinct sets (id, words).

    Word sets are made once; classes of only null ids are left out.
    """
    words = F.sort_array(word_set(text))
    sets = rows.select(F.col(id_col).alias("id"), words.alias("words")).withColumn("key", F.when(F.size("words") > 0, F.md5(F.array_join("words", " ")))).checkpoint()
    classes = sets.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(F.min("id").alias("first"), F.first("words").alias("words")).checkpoint()
    members = sets.select("id", "key").join(classes.select("key", "first"), "key", "left").select("id", "first")
    return members, classes.select(F.col("first").alias("id"), "words")


def _meeting_by_words(sets: DataFrame, threshold: float) -> DataFrame:
    """id_a < id_b of all pairs of sets that may be near, by words.

    Sets of such a pair share one of their first n - ceil(t n) + 1 words in any order common to all, so only
    these meet in a join, on the word's hash and a class of sizes; sizes and what the places still allow are
    compared before whole sets are. The order puts the FREQUENT commonest words last, which keeps the lists
    that meet short; the words of a set stay in its task while they are ordered.
    """
    hashed = sets.select("id", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    common = hashed.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("df")).orderBy(F.desc("df"), "hash").limit(FREQUENT)
    spread = hashed.repartition("id").select("id", F.size("hashes").alias("n"), F.explode("hashes").alias("hash"))
    ordered = spread.join(F.broadcast(common), "hash", "left").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0).cast("long")).alias("df"), "hash"))).alias("words"))
    head = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")
    prefix = ordered.select("id", "n", F.posexplode(F.slice("words", F.lit(1), head)).alias("place", "word"))
    # sizes of a pair are in the same class or in neighbouring ones, rounding included
    step = 1.001 * max(-math.log(max(threshold, 1e-9)), 1e-6)
    prefix = prefix.select("id", F.col("word.hash").alias("hash"), F.struct("n", "place").alias("at"), F.floor(F.log("n") / step).alias("sizes"))
    small = prefix.select(F.col("id").alias("id_a"), F.col("at").alias("a"), "hash", F.explode(F.array("sizes", F.col("sizes") + 1)).alias("sizes"))
    large = prefix.select(F.col("id").alias("id_b"), F.col("at").alias("b"), "hash", "sizes")
    size_a, size_b = F.col("a.n"), F.col("b.n")
    in_order = (size_a < size_b) | ((size_a == size_b) & (F.col("id_a") < F.col("id_b")))
    needed = F.ceil((size_a + size_b) * (threshold / (1 + threshold)) - 1e-9)
    fits = in_order & (size_a >= size_b * threshold - 1e-9) & (F.least(size_a - F.col("a.place"), size_b - F.col("b.place")) >= needed)
    return small.join(large, ["hash", "sizes"]).where(fits).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()


def _meeting_by_parts(sets: DataFrame, threshold: float) -> DataFrame:
    """id_a < id_b of all pairs of sets that may be near, by parts.

    Of the n + m words of such a pair, at most a share (1 - t) / (1 + t) is in one set only. Words are dealt by
    hash into one part more than that makes, so the two agree in a part at least and meet by its number and
    hash. The number goes by the larger one's class of sizes; a set is dealt for its own class and for the
    next. A part has about (1 + t) / 2 (1 - t) words, eleven at 0.92, so sets that share frequent words do
    not meet for it, and a set makes fewer rows than it has words.
    """
    bound_batches(sets.sparkSession)
    step, share = 1.001 * -math.log(threshold), (1 - threshold) / (1 + threshold)
    hashed = sets.select("id", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hashes")
            n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            words = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            own = np.floor(np.log(n) / step).astype(np.int64)
            for sizes in (own, own + 1):
                most = np.floor(np.exp((sizes + 1) * step)) + 1
                many = np.floor(2 * most * share + 1e-9).astype(np.int64) + 1
                first = np.cumsum(many) - many
                at = np.repeat(first, n) + ((words >> np.uint64(17)) % np.repeat(many, n).astype(np.uint64)).astype(np.int64)
                cells = np.zeros(int(many.sum()), np.uint64)
                np.add.at(cells, at, words * ODD)
                of = np.repeat(np.arange(len(n)), many)
                place = (np.arange(len(cells)) - first[of] + (sizes[of] << 32)).astype(np.uint64)
                cells = (cells ^ (cells >> np.uint64(29))) * ODD + place * ODD_TOO
                columns = [batch.column("id").take(pa.array(of)), pa.array(n[of].astype(np.int32)), pa.array(sizes[of] == own[of]), pa.array(cells.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "own", "cell"])

    dealt = hashed.mapInArrow(deal, f"id {sets.schema['id'].dataType.simpleString()}, n int, own boolean, cell long")
    small = dealt.select(F.col("id").alias("id_a"), F.col("n").alias("na"), "cell")
    large = dealt.where("own").select(F.col("id").alias("id_b"), F.col("n").alias("nb"), "cell")
    in_order = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("id_a") < F.col("id_b")))
    fits = in_order & (F.col("na") >= F.col("nb") * threshold - 1e-9)
    return small.join(large, "cell").where(fits).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()


def _near_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """id_a < id_b and jaccard of all pairs of distinct word sets at or above the threshold, exactly: those that meet are compared whole."""
    pairs = (_meeting_by_parts if PARTS_FROM <= threshold < 1 else _meeting_by_words)(sets, threshold).checkpoint()
    met = sets.join(pairs.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct(), "id", "left_semi")
    both = pairs.join(met.select(F.col("id").alias("id_a"), F.col("words").alias("wa")), "id_a").join(met.select(F.col("id").alias("id_b"), F.col("words").alias("wb")), "id_b")
    shared = F.size(F.array_intersect("wa", "wb"))
    return both.select("id_a", "id_b", (shared / (F.size("wa") + F.size("wb") - shared).cast("double")).alias("jaccard")).where(F.col("jaccard") >= threshold)


def near_pairs(rows: DataFrame, id_col: str, text: Column, threshold: float = rules.NEAR_COPY) -> DataFrame:
    """id_a < id_b and jaccard: links at or above the threshold between different word sets, and who has which set.

    A set stands for its smallest id. Links are between such ids; every other row of a set has one row, from
    that id to its own, of jaccard 1. So a group of copies gives as many rows as copies, and no link between
    different sets is lost. Rows without words or without an id are in no pair.
    """
    members, sets = _word_classes(rows, id_col, text)
    copies = members.where("id > first").select(F.col("first").alias("id_a"), F.col("id").alias("id_b"), F.lit(1.0).alias("jaccard"))
    return _near_sets(sets, threshold).unionByName(copies)


def near_first(rows: DataFrame, id_col: str, text: Column, threshold: float = rules.NEAR_COPY) -> DataFrame:
    """id and kept: in id order, a row goes if it is near any kept row before it: greedy.near_greedy without a window.

    Of equal word sets only the first row can stay. The others go in rounds over near pairs of different sets:
    one with no open one before it stays, and what is near it goes; a chain of sets near only their neighbours
    takes a round for each second one. Rows without words or without an id stay.
    """
    members, sets = _word_classes(rows, id_col, text)
    pairs = _near_sets(sets, threshold).select(F.col("id_a").alias("before"), F.col("id_b").alias("after")).checkpoint()
    gone = pairs.select(F.col("after").alias("first")).where(F.lit(False))
    while True:
        waits = pairs.select(F.col("after").alias("before")).distinct()
        stay = pairs.select("before").distinct().join(waits, "before", "left_anti").checkpoint()
        hit = pairs.join(stay, "before", "left_semi").select(F.col("after").alias("first")).distinct().checkpoint()
        if hit.isEmpty():
            break
        gone = gone.unionByName(hit).checkpoint()
        pairs = pairs.join(stay, "before", "left_anti").join(hit.withColumnRenamed("first", "after"), "after", "left_anti").join(hit.withColumnRenamed("first", "before"), "before", "left_anti").select("before", "after").checkpoint()
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    marked = members.join(gone.withColumn("__gone", F.lit(True)), "first", "left")
    return marked.select("id", (~copy & (F.col("__gone").isNull() | F.col("id").isNull())).alias("kept"))


def near_clusters(rows: DataFrame, id_col: str, text: Column, threshold: float = rules.NEAR_COPY) -> DataFrame:
    """id and cluster: the smallest id that links of near pairs lead to; a row without words is its own cluster, one without an id in none."""
    members, sets = _word_classes(rows, id_col, text)
    labels = smallest_reached(_near_sets(sets, threshold).select(F.col("id_a").alias("u"), F.col("id_b").alias("v")))
    joined = members.join(labels.withColumnRenamed("node", "first"), "first", "left")
    return joined.select("id", F.when(F.col("id").isNotNull(), F.coalesce("label", "first", "id")).alias("cluster"))


def union_ranked(*sources: DataFrame) -> DataFrame:
    """Sources end to end with source_rank, so that earlier ones win in dedup."""
    return reduce(DataFrame.unionByName, [s.withColumn("source_rank", F.lit(k)) for k, s in enumerate(sources)])
