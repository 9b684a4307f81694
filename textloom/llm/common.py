"""What the operators share: the shared folder, staged tables and table reading."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares: spark.checkpoint.dir. Unset, it is a folder of ours where all runs on one machine, as in tests; on a cluster that is an error."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="textloom-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def work_dir(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/textloom/{tag}-{uuid.uuid4().hex}"


#: Lists of the tables made within each ``temporary_tables`` of this thread or task, innermost last: runs side by side have lists of their own.
_made: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("_made", default=())


def staged(df: DataFrame, tag: str, outlives: bool = False) -> DataFrame:
    """df, written once as Parquet into the shared folder and read back: cuts lineage, survives lost executors.

    outlives: the table is kept when the innermost ``temporary_tables`` ends, and belongs to the one around
    it. A table whose writing fails belongs to the innermost one.
    """
    spark, path, made = df.sparkSession, work_dir(df.sparkSession, tag), _made.get()
    for paths in made[-1:]:
        paths.append(path)
    df.write.parquet(path)
    if outlives and made:
        made[-1].remove(path)
        for paths in made[-2:-1]:
            paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, *paths: str) -> None:
    """Deletes tables, wherever the folder is that executors share."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables staged within, in this thread, are deleted at the end: what is made from them must be written by then."""
    paths: list[str] = []
    token = _made.set((*_made.get(), paths))
    try:
        yield
    finally:
        _made.reset(token)
        delete(spark, *paths)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


#: Bytes of one Arrow batch between the JVM and Python; by rows alone, batches of long texts would be large.
ARROW_BATCH_BYTES = 4 << 20
#: A task that has read fewer bytes has little to give back, and collecting takes longer than its work.
RELEASED_BYTES = 1 << 20


def release_memory() -> None:
    """Gives what a task has freed back to the system: Python workers stay for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """df.mapInArrow with batches bounded in bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))

    def run(batches):
        read = 0

        def counted():
            nonlocal read
            for batch in batches:
                read += batch.nbytes
                yield batch

        try:
            yield from function(counted())
        finally:
            if read >= RELEASED_BYTES:
                release_memory()

    return df.mapInArrow(run, schema)
