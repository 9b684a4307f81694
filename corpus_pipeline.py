"""Documents to training rows: quality filter, exact and near dedup, mixing, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run`` writes each
result as Parquet into the shared folder and reads it back as the next stage's docs, and deletes what the
stage has staged meanwhile, and in the end all results but the mix, which the last stage reads. All stages but the last return the columns of documents, and further columns
that docs has, with their own values whatever their names. Null texts count as empty everywhere; an empty
table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textloom.llm.common import staged, table, temporary_tables
from textloom.llm.exact_dedup import drop_copies
from textloom.llm.jaccard_join import keep_one_each
from textloom.llm.mixing import mixed_documents
from textloom.llm.quality import QualityModel, keep_good
from textloom.llm.sentencepiece_viterbi import PieceModel, read_pieces, sentencepiece_digest


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on labels outside the held-out fold, scores 0.5 or more.

    Empty texts have the score of the bias alone; repeated rows and rows of a null id score like others.
    Without labels of both kinds every row has the score of the labels' kind, or 0.5 if there are none.
    """
    return keep_good(docs, QualityModel.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest doc_id; null ids come below all others, of repeated rows one stays. Empty texts are equal."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row of the smallest doc_id; null ids come last, ties go by a hash of the text. Empty texts link with nothing and stay."""
    return keep_one_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their Poisson counts, sources tempered by the square root of their size, shuffled.

    A null source is a source of its own; rows of one id, null too, share a draw; empty texts are drawn like others.
    """
    return mixed_documents(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document of the mix: doc_id, n_pieces, ids_crc32, n_bytes, round_trip, piece_ids; repeated rows each have one, empty texts no piece."""
    return sentencepiece_digest(docs, PieceModel(read_pieces(public_tokenizers.path("piece_bpe_32k.model"))), batch_bytes=1 << 19, with_ids=True)


STAGES = [("quality", quality_filter), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("mixing", mixture), ("sentencepiece", piece_ids)]

#: A trained classifier and a Viterbi search can't be told in SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with temporary_tables(spark):
        for name, stage in STAGES[:-2]:
            with temporary_tables(spark):
                docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", outlives=True)
        name, stage = STAGES[-2]
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", outlives=True)
    return STAGES[-1][1](spark, docs, sf_dir)
