"""An append stream that stops at a limit for each category, whatever is replayed or comes late."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: State is kept in this store: the operators below need one with named variables.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of one category, as a sink of examples has it.
PER_CATEGORY = 500


class FirstOfKey(StatefulProcessor):
    """Passes the first row of a key that the stream has not seen for the time to live (None: ever)."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        self.seen.update((0,))
        for frame in rows:
            if not known and len(frame):
                known = True
                yield frame.iloc[:1]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.seen.update((0,))

    def close(self) -> None:
        pass


class UpToLimit(StatefulProcessor):
    """Passes rows of a category until the limit; the count is its only state."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        for frame in rows:
            taken = frame.iloc[: max(0, self.limit - n)]
            if len(taken):
                n += len(taken)
                yield taken
        self.count.update((n,))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.count.update((int(initialState["__n"].sum()),))

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, key: Column, ttl_ms: int | None = None, seen: DataFrame | None = None) -> DataFrame:
    """The first row of each value of ``key`` (null is a value). seen: a table with the stream's columns whose keys count as seen."""
    start = seen.select(key.alias("__key")).distinct().groupBy("__key") if seen is not None else None
    return stream.withColumn("__key", key).groupBy("__key").transformWithStateInPandas(FirstOfKey(ttl_ms), stream.schema, "append", "None" if ttl_ms is None else "ProcessingTime", start)


def head_of_task(stream: DataFrame, category: str, limit: int) -> DataFrame:
    """Of each category at most ``limit`` rows of each task go on: more than that can't be wanted of rows that are all new, and a hot category doesn't reach its task whole."""

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: Counter = Counter()
        for batch in batches:
            keep = []
            for value in batch.column(category).to_pylist():
                keep.append(passed[value] < limit)
                passed[value] += 1
            yield batch.filter(pa.array(keep, pa.bool_()))

    return stream.mapInArrow(head, stream.schema)


def limited(stream: DataFrame, key: Column, category: str, limit: int = PER_CATEGORY, ttl_ms: int | None = None, there: DataFrame | None = None) -> DataFrame:
    """Rows of the stream whose key is new, until their category (null is one) has ``limit`` of them.

    The keys' state is spread by key, and forgets a key after ttl_ms of processing time if given; a
    category's state is one number. there: the table as it is, whose keys are seen and whose rows count.
    Which new rows of a category come first within a micro-batch is not defined; a full category stays full.
    With a time to live, empty micro-batches are switched off: Spark would run them without end.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    if ttl_ms is not None:
        stream.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    new = head_of_task(first_rows(stream, key.cast("string"), ttl_ms, there), category, limit)
    held = there.groupBy(F.col(category).alias("__group")).agg(F.count(F.lit(1)).alias("__n")).groupBy("__group") if there is not None else None
    return new.withColumn("__group", F.col(category)).groupBy("__group").transformWithStateInPandas(UpToLimit(limit), stream.schema, "append", "None", held)


def append_limited(stream: DataFrame, path: str, checkpoint: str, key: Column, category: str, limit: int = PER_CATEGORY, ttl_ms: int | None = None, there: DataFrame | None = None) -> StreamingQuery:
    """Appends the limited stream as Parquet files. State and the sink's log go by micro-batch, so a batch that is replayed after a failure appends nothing twice."""
    found = limited(stream, key, category, limit, ttl_ms, there)
    return found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
