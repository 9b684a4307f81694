"""Counts taken on the way of rows that are written, in the same pass."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textloom.operators.dedup import keep_first


def _steps(rows: DataFrame, kept: Column, key: Column, order: list) -> tuple[DataFrame, list[Observation]]:
    seen = [Observation() for _ in range(3)]
    n = F.count(F.lit(1)).alias("n")
    good = rows.observe(seen[0], n).where(kept).observe(seen[1], n)
    return keep_first(good, key, order).observe(seen[2], n), seen


def _count(seen: Observation) -> int:
    """What was observed; 0 where Spark has left the step out, since it knew that no row would come."""
    try:
        return seen.get["n"]
    except Py4JJavaError:
        return 0


def clean_and_count(rows: DataFrame, path: str, kept: Column, key: Column, order: list) -> dict[str, int]:
    """Writes the first row of each key among the kept rows as Parquet; returns total, normalised (kept), uniq (written) and removed.

    Counts are observed while rows pass to the writer, so rows is read once. A stage that runs again after
    an executor was lost may have counted its rows twice: if the count of what was written differs from
    the files, or more rows came out than went in, everything is counted anew.
    """
    found, seen = _steps(rows, kept, key, order)
    found.write.mode("overwrite").parquet(path)
    total, normalised, uniq = map(_count, seen)
    written = rows.sparkSession.read.parquet(path).count()
    if uniq != written or not total >= normalised >= uniq:
        counted = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("normalised")).first()
        total, normalised, uniq = counted["total"], counted["normalised"], written
    return {"total": total, "normalised": normalised, "uniq": uniq, "removed": total - uniq}
