"""Spark-first curation and analysis of text corpora."""
