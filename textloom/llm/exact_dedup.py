"""Exact dedup by two-pass Bloom filtering, in DataFrame expressions only.

Pass 1 digests every row (SHA-256 of the normalised text) and counts how many rows hit each of two
filter slots per digest, both in the digest's block of the filter. Slots hit at least twice form the
bitmaps of a Bloom filter of digests that may repeat. Pass 2 tests every digest against its block's bitmap:
rows that miss pass straight through, and only the rest shuffle to be grouped exactly. False positives cost
a little shuffle, never a result, so the filter has a fixed size at most: more rows than it was made for
give more false positives, not a larger broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import staged, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_ROW = 16
BLOCK_BITS = 15
#: Bits of the whole filter at most, a broadcast of 64 MB: BITS_PER_ROW for each of 33.5 million rows.
MAX_BITS = 1 << 29


def folded(text: Column) -> Column:
    """text with A-Z, and no other letter, in lower case."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_digest(name: str = "text") -> Column:
    return F.sha2(folded(text_or_empty(name)).cast("binary"), 256)


class RepeatFilter:
    """Bitmaps of the digests that may occur more than once; ``flag`` adds the verdict to any rows."""

    def __init__(self, digests: DataFrame, column: str, max_bits: int = MAX_BITS):
        rows = max(1, digests.count())
        self.blocks = min(1 << max(BLOCK_BITS, (rows * BITS_PER_ROW - 1).bit_length()), max(max_bits, 1 << BLOCK_BITS)) >> BLOCK_BITS
        block, a, b = self._places(F.col(column))
        hit = digests.select(block.alias("block"), F.explode(F.array_distinct(F.array(a, b))).alias("slot"))
        repeated = hit.groupBy("block", "slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        self.bitmaps = staged(repeated.groupBy("block").agg(F.bitmap_construct_agg("slot").alias("bitmap")), "repeat-filter")

    def _places(self, digest: Column) -> tuple[Column, Column, Column]:
        """A digest's block, and its two slots there."""
        h, low = F.xxhash64(digest), F.lit((1 << BLOCK_BITS) - 1)
        return F.pmod(F.xxhash64(F.lit("block"), digest), F.lit(self.blocks)), h.bitwiseAND(low), F.shiftrightunsigned(h, 32).bitwiseAND(low)

    def _bit(self, slot: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("__bitmap"), F.shiftright(slot, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.getbit(byte, slot.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))

    def flag(self, rows: DataFrame, column: str, name: str = "may_repeat") -> DataFrame:
        """rows with a boolean: False only where no other row has the digest.

        The filter is one broadcast, a row for each block of 4 KB, never more than max_bits. Rows are not shuffled.
        """
        block, a, b = self._places(F.col(column))
        maps = F.broadcast(self.bitmaps.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap")))
        return rows.withColumn("__of", block).join(maps, F.col("__of") == F.col("__block"), "left").select(*rows.columns, (self._bit(a) & self._bit(b)).alias(name))


def repeat_groups(flagged: DataFrame, id_col: str, digest: str) -> DataFrame:
    """Groups of two rows or more: digest, keep_id, keep_row, group_size. Aggregates by (digest, id) first."""
    by_id = flagged.groupBy(digest, id_col).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    groups = by_id.groupBy(digest).agg(F.max(F.struct(F.col(id_col).alias("id"), F.col("row"), F.col("n"))).alias("keep"), F.sum("n").alias("group_size"))
    return groups.where("group_size > 1").select(digest, F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"), F.col("keep.n").alias("keep_rows"), "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after A-Z are lower-cased. Null text counts as empty; a null id sorts
    below every other; of rows with equal text and id one, chosen by read order, stays. An empty table
    gives no rows. Other columns of ``docs`` are not read, so their names don't matter.
    """
    digests = staged(docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("text_sha256"), F.monotonically_increasing_id().alias("row")), "digests")
    seen = RepeatFilter(digests, "text_sha256", max_bits).flag(digests, "text_sha256")
    groups = staged(repeat_groups(seen.where("may_repeat"), "doc_id", "text_sha256"), "repeat-groups")
    alone = seen.where("NOT may_repeat").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    together = seen.where("may_repeat").join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(together)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """docs without the rows that exact_dedup does not keep; every column stays as it is, whatever its name.

    Rows whose digest cannot repeat are not shuffled. Of rows equal in text and id one stays. Null text
    counts as empty, a null id sorts below every other, and an empty table stays empty.
    """
    own = docs.withColumn("__sha", text_digest(text_col))
    digests = staged(own.select(F.col(id_col).alias("__id"), "__sha", F.monotonically_increasing_id().alias("row")), "digests")
    bloom = RepeatFilter(digests, "__sha", max_bits)
    groups = repeat_groups(bloom.flag(digests, "__sha").where("may_repeat"), "__id", "__sha")
    groups = staged(groups.select("__sha", *[F.col(c).alias(f"__{c}") for c in ("keep_id", "keep_rows", "group_size")]), "repeat-groups")
    rows = bloom.flag(own, "__sha", "__may")
    held = rows.where("__may").join(groups, "__sha", "left").where(F.col("__group_size").isNull() | F.col(id_col).eqNullSafe(F.col("__keep_id")))
    once = held.where(F.col("__group_size").isNull() | (F.col("__keep_rows") == 1))
    again = held.where("__keep_rows > 1").dropDuplicates(["__sha"])
    return reduce(DataFrame.unionByName, [x.select(*docs.columns) for x in (rows.where("NOT __may"), once, again)])
