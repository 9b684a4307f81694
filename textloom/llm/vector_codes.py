"""Product codes of integer vectors, with partial-distance search for the nearest codebook entry.

A vector is cut into equal parts, and each part has a codebook of its own, fitted in rounds of assignment
and integer means. The search takes a part's dimensions in descending variance of the codebook: squared
differences add up, and an entry drops out for a vector as soon as its sum is strictly above the distance
of the best entry that is complete. What a round needs from the data are the count and the sum of each
part, entry and position, added up in each task before they are shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import map_batches, staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components up to this size have distances and their sums in 64 bits; a batch with larger ones is computed with Python's integers.
SMALL = 1 << 27
#: Vectors searched at once.
ROWS = 8192
#: Sums travel in limbs of this many bits, each with the sum's sign.
LIMB_BITS = 40
#: Totals of labels are broadcast up to this many labels.
BROADCAST_LABELS = 50_000


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as 64-bit integers where all are small, as Python's integers otherwise."""
    values = values.astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not len(values) or np.abs(scaled).max() <= SMALL:
        return scaled.astype(np.int64)
    return np.array([math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale for x in values.tolist()], object)


def search_order(codebook: np.ndarray) -> list[int]:
    """Positions of a part by descending variance of the entries there (exact, times the square of their number), ties to the lower position."""
    rows = codebook.astype(object)
    n = len(rows)
    spread = [n * sum(x * x for x in column) - sum(column) ** 2 for column in rows.T.tolist()]
    return sorted(range(rows.shape[1]), key=lambda d: (-spread[d], d))


def nearest_entries(vectors: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the index of the nearest entry (squared Euclidean distance, ties to the lower index), and the distance.

    The entry nearest in the leading dimension alone is completed first; every other entry is dropped for
    a row once its partial sum is strictly above the best complete distance of that row.
    """
    order = search_order(codebook)
    lead = (vectors[:, order[0], None] - codebook[None, :, order[0]]) ** 2
    code = np.argmin(lead, axis=1) if lead.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in lead.tolist()], np.int64)
    best = ((vectors - codebook[code]) ** 2).sum(axis=1)
    for entry in range(len(codebook)):
        alive = np.flatnonzero((lead[:, entry] <= best) & (code != entry))
        total = lead[alive, entry]
        for d in order[1:]:
            if not len(alive):
                break
            total = total + (vectors[alive, d] - codebook[entry, d]) ** 2
            within = total <= best[alive]
            alive, total = alive[within], total[within]
        better = (total < best[alive]) | ((total == best[alive]) & (entry < code[alive]))
        best[alive[better]], code[alive[better]] = total[better], entry
    return code, best


def _limbs(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB_BITS) - 1)))
        value >>= LIMB_BITS
    return out


def _vectors(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    """The batch's vectors as a matrix; all have ``dimension`` components, none null."""
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return integers(values).reshape(-1, dimension)


def _summer(codebooks: list[np.ndarray], dimension: int):
    """mapInArrow function: counts and sums of each part, entry and position in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, n_entries = dimension // len(codebooks), len(codebooks[0])
        counts = np.zeros((len(codebooks), n_entries), np.int64)
        sums = np.zeros((len(codebooks), n_entries, width), object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                block = _vectors(batch.slice(at, ROWS), dimension)
                for p, codebook in enumerate(codebooks):
                    own = block[:, p * width : (p + 1) * width]
                    code, _ = nearest_entries(own, codebook)
                    counts[p] += np.bincount(code, minlength=n_entries)
                    for entry in np.unique(code).tolist():
                        sums[p, entry] += [int(x) for x in own[code == entry].sum(axis=0)]
        rows = [(p, e, -1, _limbs(int(counts[p, e]))) for p, e in zip(*np.nonzero(counts), strict=True)]
        rows += [(p, e, d, _limbs(sums[p, e, d])) for p, e, *_ in rows for d in range(width)]
        rows = [(p, e, d, k, x) for p, e, d, limbs in rows for k, x in enumerate(limbs) if x]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], pa.int64()) for c in zip(*rows, strict=True)], names=["part", "entry", "position", "limb", "value"])

    return run


def _coder(codebooks: list[np.ndarray], dimension: int):
    """mapInArrow function: code and error of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = dimension // len(codebooks)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                own = batch.slice(at, ROWS)
                block = _vectors(own, dimension)
                codes, error = [], np.zeros(len(block), object)
                for p, codebook in enumerate(codebooks):
                    code, best = nearest_entries(block[:, p * width : (p + 1) * width], codebook)
                    codes.append(code)
                    error = error + best
                text = ["".join(f"{x:02x}" for x in row) for row in np.array(codes).T.tolist()]
                errors = [e if e < 1 << 63 else None for e in (int(x) for x in error.tolist())]
                yield pa.RecordBatch.from_arrays([own.column("vec_id"), own.column("label"), pa.array(text, pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def fit_codebooks(kept: DataFrame, first: np.ndarray, parts: int = PARTS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks of integer entries by part, from the given first vectors. kept: column vector, all of one length and without nulls."""
    dimension = first.shape[1]
    width = dimension // parts
    codebooks = [first[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    for _ in range(rounds):
        sums = map_batches(kept.select("vector"), _summer(codebooks, dimension), "part long, entry long, position long, limb long, value long")
        found: dict[tuple[int, int, int], int] = {}
        for r in sums.groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value")).collect():  # entries x (dimension + parts) sums at most
            at = (r["part"], r["entry"], r["position"])
            found[at] = found.get(at, 0) + (r["value"] << (LIMB_BITS * r["limb"]))
        for p, codebook in enumerate(codebooks):
            rows = [[found.get((p, e, d), 0) // found[p, e, -1] for d in range(width)] if (p, e, -1) in found else codebook[e].tolist() for e in range(len(codebook))]
            large = any(abs(x) > SMALL for row in rows for x in row)
            codebooks[p] = np.array(rows, object if large else np.int64).reshape(len(rows), width)
    return codebooks


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for codebook in codebooks for row in codebook.tolist() for x in row).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every vector that takes part.

    Left out are vectors that are null, empty, hold null or non-finite components, or are of another length
    than the one of the smallest vec_id; that length must be a multiple of ``parts``. Null vec_ids come
    last among the first codebook's, rows of one vec_id by their components; fewer vectors than ``entries``
    give as many entries. Ties go to the lower index, equal rows have equal codes. label_error adds up
    all rows of a label, nulls together; an error, or a sum of errors, beyond 64 bits is null. An empty
    table gives no row. Other columns are ignored.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    own = own.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite))
    nothing = spark.createDataFrame([], own.select("vec_id", "label").schema).selectExpr("vec_id", "label", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256")
    smallest = lambda df: df.orderBy(F.col("vec_id").asc_nulls_last(), "vector")
    leader = smallest(own).select("vector").first()
    if leader is None:
        return nothing
    dimension = len(leader[0])
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} components cannot be cut into {parts} equal parts")
    kept = own.where(F.size("vector") == dimension)
    head = integers(np.array([x for r in smallest(kept).limit(entries).select("vector").collect() for x in r[0]])).reshape(-1, dimension)
    codebooks = fit_codebooks(kept, head, parts, rounds)
    label = dict(kept.dtypes)["label"]
    coded = staged(map_batches(kept, _coder(codebooks, dimension), f"vec_id long, label {label}, code string, error long"), "vector-codes")
    total = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    totals = staged(coded.groupBy(F.col("label").alias("__label")).agg(total.alias("total")).select("__label", F.expr("try_cast(total AS long)").alias("label_error")), "label-errors")
    few = totals.count() <= BROADCAST_LABELS
    found = coded.join(F.broadcast(totals) if few else totals, F.col("label").eqNullSafe(F.col("__label")))
    return found.select("vec_id", "label", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))


def decoded(code: str, codebooks: list[np.ndarray]) -> list[int]:
    """The integer vector that a code stands for."""
    return [x for p, codebook in enumerate(codebooks) for x in codebook[int(code[2 * p : 2 * p + 2], 16)].tolist()]
