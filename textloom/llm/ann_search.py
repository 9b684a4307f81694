"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

A unit vector is turned by fast Hadamard pseudo-rotations (random signs, then a Hadamard transform, three
times) and hashed to its nearest signed axis. Each table joins as many full hashes, and a last one over
fewer axes, as give buckets of about ``bucket_size`` vectors. A query looks into the best buckets of each
table; what it finds is reranked by exact distance on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.common import map_batches, staged

TABLES, PROBES, BUCKET_SIZE, AXES_TRIED = 64, 12, 4, 16
#: Beyond so many vectors the probes grow as their number to this power: neighbours a little closer than
#: the rest share a bucket ever more rarely, and recall would fall otherwise.
STEADY_ROWS, PROBE_GROWTH = 50_000, 0.37
SEED = 20


def probes_for(rows: int) -> int:
    return math.ceil(PROBES * max(1.0, rows / STEADY_ROWS) ** PROBE_GROWTH)


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(rows, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, width)
        half *= 2
    return x / math.sqrt(width)


class CrossPolytope:
    """Hash functions of one dimension; the same seed gives the same functions everywhere."""

    def __init__(self, dimension: int, rows: int, tables: int, bucket_size: int, seed: int = SEED):
        self.width = 1 << max(1, (dimension - 1).bit_length())
        self.tables, self.seed = tables, seed
        buckets, self.axes = max(2.0, rows / bucket_size), []
        while buckets > 3 * self.width:
            self.axes.append(self.width)
            buckets /= 2 * self.width
        self.axes.append(int(min(self.width, max(1, math.ceil(buckets / 2)))))

    def _signed(self, x: np.ndarray, table: int) -> Iterator[np.ndarray]:
        """Per hash of the table: the products of each row with the signed axes."""
        for part, axes in enumerate(self.axes):
            signs = np.random.default_rng([self.seed, self.width, table, part])
            y = x
            for _ in range(3):
                y = _hadamard(y * signs.choice([-1.0, 1.0], self.width))
            yield np.concatenate([y[:, :axes], -y[:, :axes]], axis=1)

    def padded(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros((len(vectors), self.width))
        out[:, : vectors.shape[1]] = vectors
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    def buckets(self, unit: np.ndarray, table: int) -> np.ndarray:
        code = np.zeros(len(unit), np.int64)
        for products in self._signed(unit, table):
            code = code * products.shape[1] + products.argmax(axis=1)
        return code

    def probes(self, unit: np.ndarray, table: int, count: int) -> np.ndarray:
        """The ``count`` best buckets of each row, or all: those of the largest sums of products."""
        codes, sums = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
        for products in self._signed(unit, table):
            tried = np.argsort(-products, axis=1, kind="stable")[:, : min(products.shape[1], AXES_TRIED)]
            value = np.take_along_axis(products, tried, axis=1)
            codes = (codes[:, :, None] * products.shape[1] + tried[:, None, :]).reshape(len(unit), -1)
            sums = (sums[:, :, None] + value[:, None, :]).reshape(len(unit), -1)
            best = np.argsort(-sums, axis=1, kind="stable")[:, :count]
            codes, sums = np.take_along_axis(codes, best, axis=1), np.take_along_axis(sums, best, axis=1)
        return codes


def _hashed(vectors: DataFrame, maker: dict[int, CrossPolytope], probes: dict[int, int] | None) -> DataFrame:
    """vec_id, dimension, table, bucket: one row a table, or one a table and probe."""

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            values, ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), batch.column("vec_id").to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            for dimension in np.unique(sizes):
                at = np.flatnonzero(sizes == dimension)
                hashes = maker[int(dimension)]
                unit = hashes.padded(values[first[at][:, None] + np.arange(dimension)])
                for table in range(hashes.tables):
                    codes = hashes.buckets(unit, table)[:, None] if probes is None else hashes.probes(unit, table, probes[int(dimension)])
                    n = codes.size
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids[at], codes.shape[1])), pa.array(np.full(n, dimension, np.int32)), pa.array(np.full(n, table, np.int32)), pa.array(codes.ravel())], names=["vec_id", "dimension", "table", "bucket"]
                    )

    return map_batches(vectors, hash_rows, "vec_id long, dimension int, table int, bucket long")


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vector (array<double>) of the rows that take part; of rows with one id the smallest vector."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.where(finite & F.exists("vector", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _distance(pairs: DataFrame) -> DataFrame:
    """query_id, vec_id, score of pairs with vectors q and v of one length."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, v = batch.column("q"), batch.column("v")
            size = pa.compute.list_value_length(q).to_numpy(zero_copy_only=False).astype(np.int64)
            gap = q.flatten().to_numpy(zero_copy_only=False) - v.flatten().to_numpy(zero_copy_only=False)
            score = np.sqrt(np.add.reduceat(gap * gap, np.concatenate([[0], np.cumsum(size)[:-1]]))) if len(size) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec_id"), pa.array(score)], names=["query_id", "vec_id", "score"])

    return map_batches(pairs.select("query_id", "vec_id", "q", "v"), measure, "query_id long, vec_id long, score double")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, probes: int | None = None, bucket_size: int = BUCKET_SIZE
) -> DataFrame:
    """query_id, rank, vec_id, score: of each query row the k nearest other rows found, by Euclidean distance.

    is_query: a condition on vec_id. Ties go to the smaller vec_id. Null ids, and vectors null, empty, zero
    or with null or non-finite components take no part; vectors meet only those of their own length; of
    rows with one id the smallest vector counts. Of rows with one vector the k + 1 smallest ids can be
    among the k nearest and no other is hashed, so a very common vector adds no more than that. A query with fewer than k
    others in its buckets has fewer rows; nothing is returned for an empty table.
    """
    rows = staged(usable(vectors, id_col, vector_col), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("dimension")).count().collect()  # a row for each vector length
    maker = {r["dimension"]: CrossPolytope(r["dimension"], r["count"], tables, bucket_size) for r in sizes}
    tried = {r["dimension"]: probes or probes_for(r["count"]) for r in sizes}
    same = Window.partitionBy("vector").orderBy("vec_id")
    indexed = staged(rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth"), "indexed-vectors")
    queries = rows.where(is_query)
    probed = _hashed(queries, maker, tried).withColumnRenamed("vec_id", "query_id")
    stored = _hashed(indexed, maker, None)
    found = probed.join(stored, ["dimension", "table", "bucket"]).where("query_id != vec_id").select("query_id", "vec_id").distinct()
    pairs = found.join(queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("q")), "query_id").join(indexed.select("vec_id", F.col("vector").alias("v")), "vec_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return _distance(pairs).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
