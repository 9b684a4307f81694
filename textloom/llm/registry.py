"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import sql
from textloom.llm.ann_search import nearest
from textloom.llm.common import table
from textloom.llm.exact_dedup import exact_dedup
from textloom.llm.jaccard_join import jaccard_components
from textloom.llm.mixing import mix_sources
from textloom.llm.packing import pack_documents
from textloom.llm.prefix_trie import conversation_trie
from textloom.llm.quality import quality_scores
from textloom.llm.secret_scan import find_secrets
from textloom.llm.sentencepiece_viterbi import PieceModel, read_pieces, sentencepiece_digest
from textloom.llm.suffix_dedup import remove_repeats
from textloom.llm.token_store import write_token_store
from textloom.llm.vector_codes import compress_vectors
from textloom.llm.wordpiece_count import pieces_of_byte_bpe, wordpiece_counts


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_token_store(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).digest()


def op2_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece_counts(table(spark, sf_dir, "documents"), *pieces_of_byte_bpe(public_tokenizers.path("byte_bpe_50k.json")))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_digest(table(spark, sf_dir, "documents"), PieceModel(read_pieces(public_tokenizers.path("piece_bpe_32k.model"))))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op7_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", "copies", "order_key", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_token_store, op2_wordpiece_counts, op3_sentencepiece, op4_suffix_dedup, op5_jaccard_join, op6_secret_scan, op7_ann_search, op8_exact_dedup, op9_quality, op10_mixing, op11_packing, op12_prefix_trie, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return own | {"op5_jaccard_join": sql.JACCARD_JOIN, "op6_secret_scan": sql.secret_scan(), "op8_exact_dedup": sql.EXACT_DEDUP, "op10_mixing": sql.MIXING, "op12_prefix_trie": sql.prefix_trie(), "op13_vector_codes": sql.vector_codes()}
