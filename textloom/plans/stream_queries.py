"""Streams over the tables, run until nothing is left to read."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.plans.registry import fresh_folder, query, read
from textloom.streaming import limited


@query("SELECT source, least(20, count(DISTINCT md5(coalesce(text, '')))) AS n FROM documents GROUP BY source")
def stream_limit(spark, sf_dir):
    """Documents as a stream that appends new texts of each source until it has twenty."""
    rows = read(spark, sf_dir, "documents")
    stream = spark.readStream.schema(rows.schema).parquet(f"{sf_dir}/documents.parquet*").select("source", F.md5(F.coalesce("text", F.lit(""))).alias("h"))
    out, checkpoint = fresh_folder(spark, "limited"), fresh_folder(spark, "limited-state")
    key = F.concat_ws("|", F.coalesce("source", F.lit("")), F.col("source").isNull().cast("string"), "h")
    limited.append_limited(stream, out, checkpoint, key, "source", 20).awaitTermination()
    return spark.read.schema("source string, h string").parquet(out).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
