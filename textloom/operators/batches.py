"""Arrow batches bounded in bytes: by rows alone, batches of long texts would be large."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Bytes of one batch between the JVM and Python.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Batches of what runs from now on hold BATCH_BYTES or one row."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
