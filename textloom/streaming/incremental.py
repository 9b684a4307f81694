"""Streams: dedup with bounded state, windowed counts, appends without repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.sources.jsonl import append_unseen


def first_within(stream: DataFrame, key: Column, time: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key; state is dropped once the watermark has passed."""
    return stream.withColumn("__key", key).withWatermark(time, late).dropDuplicatesWithinWatermark(["__key"]).drop("__key")


def windowed_counts(stream: DataFrame, time: str, *keys: str, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    counted = stream.withWatermark(time, late).groupBy(F.window(time, size).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "n")


def append_stream(stream: DataFrame, path: str, key: Column, checkpoint: str) -> StreamingQuery:
    """Each micro-batch appends the rows whose key the table lacks; a batch replayed after a failure adds nothing."""
    return stream.writeStream.foreachBatch(lambda batch, _: append_unseen(batch, path, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
