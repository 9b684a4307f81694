"""Connected components by alternating large-star and small-star steps over an edge table.

Each partition first replaces its edges by stars of the same components; what few edges are left then make
their components in a task, more of them by the steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import map_batches, staged, temporary_tables

#: So many edges at most make their components in a task; a partition's stars are put out when they have twice as many nodes.
FEW_EDGES = 1 << 17


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum of their hashes: the same only if nothing changed."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """node, label: for every node of edges (u, v), the smallest node it is connected with.

    Loops and repeated edges don't matter; no edges give no rows. Minima are aggregated before each shuffle;
    the joins on a hub are between plain shuffles, which adaptive execution splits. The tables of the steps
    are deleted at the end.
    """
    with temporary_tables(edges.sparkSession):
        fewer = staged(_contracted(edges.where("u != v").select("u", "v")), "stars-of-partitions")
        if fewer.count() > FEW_EDGES:
            return staged(_stars(fewer), "labels", outlives=True)
        stars = staged(_contracted(fewer.coalesce(1)), "stars").select(F.col("u").alias("node"), F.col("v").alias("label"))
        return staged(stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct()), "labels", outlives=True)


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v), v the smallest node of a star, that connect what the edges of each partition do."""
    most = 2 * FEW_EDGES

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        kind = None

        def root(node):
            while (up := parent.setdefault(node, node)) != node:
                parent[node] = node = parent[up]
            return node

        def stars() -> pa.RecordBatch:
            found = [(node, root(node)) for node in list(parent)]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found if x[0] != x[1]], kind) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            kind = batch.column("u").type
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                if len(parent) >= most and not (u in parent and v in parent):
                    yield stars()
                    parent.clear()
                x, y = root(u), root(v)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        if parent:
            yield stars()

    return map_batches(edges, contract, edges.schema)


def _stars(edges: DataFrame) -> DataFrame:
    big, small = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = staged(edges.where("u != v").select(big, small).distinct(), "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "large-star")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.where("u != m").select("u", F.col("m").alias("v")))
        now = staged(large.where("u != v").distinct(), "edges")
        least = staged(now.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        pulled = now.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(pulled.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        was, mark = mark, _mark(now)
        if was == mark:
            break
    hubs = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(hubs)
