"""Exact Jaccard self-join of word n-gram sets, by pivots, Voronoi regions and the triangle inequality.

Distance is 1 - |A & B| / |A | B|, a metric. Whole documents make poor first pivots, nearly all of them being
at distance 1 from each other, so the first level's pivots are single shingles: a document within the radius
of another shares one of the first |A| - ceil(t |A|) + 1 shingles of any fixed order, so it is replicated
into the regions of these pivots, and linked documents meet in a region. The order puts shingles found
often last, which keeps regions of common passages from forming; it never changes the result. The documents
of large regions meet once more by the order of what is frequent among them, and large regions are then parted
by size: a pair meets in the band of its smaller set, where a document stays only if its place leaves enough
shingles for a link with the smallest set of the band. Of a large group of near copies those with many changes go so.

Every region of more than SMALL documents is then joined recursively by pivots that are documents. Distances
to a few pivots are measured, up to three radii: min(distance, cap) is a metric too, and beyond the cap sizes
and counts by hash parts (which the triangle inequality bounds by |A ^ B|) tell without whole sets. A document
goes to the cell of its nearest pivot, its Voronoi region, and is replicated into the cell of each pivot that
is farther by two radii at most; what is beyond the cap from every pivot, and what is within a radius of that
cap, makes a residual cell. What links to a pivot is one class with it, so of a cell only those who do not
link to its pivot go on, with those whose distance to it is within a radius of theirs. Cells of one class
are done, equal cells are joined once, and a cell that its pivots do not part stays whole, less these pivots.
Of a cell with classes left, pivots come from the smaller ones; once it fits into a task it is joined there.
So is a larger one whose smaller classes are few: they go to several tasks, each with a part of the largest class.

In regions of SMALL documents at most all pairs are candidates, pruned by windows on sizes, places of the
shared pivot and counts by parts, then compared on whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import map_batches, staged, temporary_tables, text_or_empty
from textloom.llm.star_components import components
from textloom.llm.wordbatch import SPACE, flat, regrouped, word_bounds

WORDS, NUMERATOR, DENOMINATOR = 5, 80, 100
#: Pairs within a region of at most so many documents are all candidates.
SMALL = 48
#: Pivots of a larger region at first; each level of the recursion has twice as many.
PIVOTS = 8
#: After the first level, a cell of at most so many documents and shingles in all is joined within a task.
TASK_CELL, TASK_SHINGLES = 2048, 1 << 21
#: Sizes of one band differ by this factor at most.
BAND = 1.02
#: Distances to pivots are measured up to so many radii.
CAP_RADII = 3
EPSILON = 1e-9
#: Shingles counted when so many bytes of text have them this often; of those found this often in all, at most so many go last.
COUNTED_BYTES, COUNTED_OFTEN, OFTEN, OFTEN_SHINGLES = 12 << 20, 2, 4, 1 << 18
#: A set of n shingles is counted in a power of two of parts, this many at least and n / 8 at least.
LEAST_PARTS = 64
BATCH_BYTES = 2 << 20
#: More keys than this are not broadcast by a hint; about 8 MB.
BROADCAST_KEYS = 1 << 17
MIX = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MIX), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z in lower case, and the n + 1 bounds of each text's words."""
    lowered = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint64)
    starts, ends = word_bounds(raw, off, ~SPACE[raw])
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(raw), MIX, np.uint64)]))
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((lowered + np.uint64(1)) * power[:-1], out=prefix[1:])
    undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(raw), INVERSE, np.uint64)]))
    return _mixed((prefix[ends] - prefix[starts]) * undo[starts]), np.searchsorted(starts, off)


def shingle_sets(texts: pa.Array, n_words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has one shingle, one without words none."""
    words, bounds = word_hashes(*flat(texts))
    many = max(0, len(words) - n_words + 1)
    rolled = words[:many].copy()
    for k in range(1, n_words):
        rolled = rolled * MIX + words[k : many + k]
    rolled = _mixed(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n_words:
            own = np.sort(rolled[a : b - n_words + 1])
            fresh = np.empty(len(own), bool)
            fresh[0] = True
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        elif b > a:
            h = words[a : a + 1] + np.uint64(b - a)  # its own length tells it from longer texts' shingles
            for k in range(a + 1, b):
                h = h * MIX + words[k : k + 1]
            out.append(_mixed(h ^ MIX))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(own: np.ndarray) -> bytes:
    """A 128-bit hash of a set."""
    with np.errstate(over="ignore"):
        sums = np.array([_mixed(own).sum(dtype=np.uint64), _mixed(own ^ MIX).sum(dtype=np.uint64)])
        return _mixed(sums * MIX + np.uint64(len(own))).tobytes()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def frequent_shingles(rows: DataFrame, sets_of, source: str) -> np.ndarray:
    """Hashes of shingles that many rows have: a bounded list, used for nothing but the order.

    sets_of: makes the shingle sets of a column ``source`` of rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
            every = np.sort(np.concatenate(sets))
            far = np.flatnonzero(every[COUNTED_OFTEN - 1 :] == every[: max(0, len(every) - COUNTED_OFTEN + 1)])
            values, n = np.unique(every[far], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n + (COUNTED_OFTEN - 1))], names=["shingle", "n"])

        held: list[np.ndarray] = []
        size = 0
        for batch in regrouped(batches, source, BATCH_BYTES):
            held += sets_of(batch.column(source))
            size += batch.column(source).nbytes
            if size >= COUNTED_BYTES:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    found = map_batches(rows, count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
    top = found.orderBy(F.desc("n"), "shingle").limit(OFTEN_SHINGLES).select("shingle").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


def _pivots(own: np.ndarray, often: np.ndarray, numerator: int, denominator: int) -> np.ndarray:
    """The shingles of a set that are its pivots: the first of the order by (often, hash)."""
    n = len(own)
    if n and len(often):
        common = often[np.minimum(np.searchsorted(often, own), len(often) - 1)] == own
        own = np.concatenate([own[~common], own[common]])
    return own[: n - -(-n * numerator // denominator) + 1 if n else 0].view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def _stored_sets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _reordered(sets: DataFrame, often: np.ndarray, numerator: int, denominator: int) -> DataFrame:
    """key, n and pivots of stored sets in another order."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _stored_sets(batch.column("shingles"))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([len(x) for x in own], pa.int32()), _lists([_pivots(x, often, numerator, denominator) for x in own])], names=["key", "n", "pivots"])

    return map_batches(sets, describe, "key binary, n int, pivots array<long>")


def _described(rows: DataFrame, often: np.ndarray, n_words: int, numerator: int, denominator: int) -> DataFrame:
    """doc_id, key, n, parts and the shingles of the document's pivots in order."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text", BATCH_BYTES):
            keys, sizes, parts, firsts = [], [], [], []
            for own in shingle_sets(batch.column("text"), n_words):
                n = len(own)
                keys.append(set_key(own))
                sizes.append(n)
                many = max(LEAST_PARTS, 1 << (-(-n // 8) - 1).bit_length() if n else 0)
                part = np.bincount((own & np.uint64(many - 1)).astype(np.int64), minlength=many)
                parts.append(np.minimum(part, 255).astype(np.uint8).tobytes())
                firsts.append(_pivots(own, often, numerator, denominator))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(parts, pa.binary()), _lists(firsts)],
                names=["doc_id", "key", "n", "parts", "pivots"],
            )

    return map_batches(rows, describe, "doc_id long, key binary, n int, parts binary, pivots array<long>")


def _whole_sets(rows: DataFrame, wanted: DataFrame, n_words: int) -> DataFrame:
    """key, shingles (sorted, 8 bytes each) of the wanted (key, first_id), from the rows that have that id."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text", BATCH_BYTES):
            sets = shingle_sets(batch.column("text"), n_words)
            yield pa.RecordBatch.from_arrays([pa.array([set_key(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["key", "shingles"])

    ids = _limited(wanted.select("first_id").distinct())
    own = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    return map_batches(own, collect, "key binary, shingles binary").join(_limited(wanted.select("key")), "key", "left_semi").dropDuplicates(["key"])


def _windows(numerator: int, denominator: int) -> Column:
    """Whether sizes na, nb and places pa, pb of a shared pivot allow a link if no pivot before it is shared.

    A pair that links passes in the region of its first shared pivot, so it is enough to let it pass there.
    """
    common = F.lit(1) + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
    least = F.least("na", "nb")
    return (least * denominator >= F.greatest("na", "nb") * numerator) & (common * (numerator + denominator) >= (F.col("na") + F.col("nb")) * numerator)


def _near_in_parts(pairs: DataFrame, sketches: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs whose part counts are close enough."""
    a = sketches.select(F.col("key").alias("a"), F.col("parts").alias("qa"), F.col("n").alias("na"))
    b = sketches.select(F.col("key").alias("b"), F.col("parts").alias("qb"), F.col("n").alias("nb"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [batch.column(c).to_pylist() for c in ("qa", "qb")]
            sizes = np.array([[len(x) for x in side] for side in counts], np.int64).reshape(2, -1)
            gap = np.zeros(batch.num_rows, np.int64)
            for both in np.unique(sizes, axis=1).T.tolist():
                at = np.flatnonzero((sizes[0] == both[0]) & (sizes[1] == both[1]))
                # parts are low bits of hashes, so a finer count folds into a coarser one
                x, y = (np.frombuffer(b"".join(side[i] for i in at), np.uint8).reshape(len(at), -1, min(both)).sum(axis=1, dtype=np.int64) for side in counts)
                gap[at] = np.abs(x - y).sum(axis=1)
            total = sum(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("na", "nb"))
            yield batch.select(["a", "b"]).filter(pa.array(gap * (numerator + denominator) <= total * (denominator - numerator)))

    return map_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "qa", "qb", "na", "nb"), near, "a binary, b binary")


def _measured(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """u, v, far, linked: the distance of each pair's whole sets, and whether it is similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, linked = [], []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                common = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                either = (len(x) + len(y)) // 8 - common
                far.append(1 - common / either)
                linked.append(denominator * common >= numerator * either)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(far, pa.float64()), pa.array(linked, pa.bool_())], names=["u", "v", "far", "linked"])

    a = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    return map_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb"), compare, "u binary, v binary, far double, linked boolean")


def _linked(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """u, v: the pairs whose whole sets are similar enough."""
    return _measured(pairs, sets, numerator, denominator).where("linked").select("u", "v")


def _limited(keys: DataFrame) -> DataFrame:
    """keys, with a broadcast hint if they are few enough; otherwise Spark shuffles both sides and splits hot keys."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _regions(described: DataFrame) -> DataFrame:
    """shingle, key, n, place, crowd: the documents of each pivot that more than one has.

    Counts are summed before their shuffle, so no task gathers a hot pivot's documents.
    """
    postings = described.select("key", "n", F.posexplode("pivots").alias("place", "shingle"))
    crowds = staged(postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1"), "crowds")
    return postings.join(_limited(crowds), "shingle").select("shingle", "key", "n", "place", "crowd")


def _by_size(regions: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """shingle, key, n, place, crowd: regions parted by bands of size, without what can't link there.

    A document goes to its own band and those of smaller sets that it may link with. Bands that are nobody's
    own are left out: every pair has its smaller set in its own band.
    """
    n, band = F.col("n").cast("long"), lambda size: F.floor(F.log(size) / F.lit(math.log(BAND)))
    least = F.ceil(n * numerator / denominator)
    dealt = regions.select("shingle", "key", "n", "place", band(n).alias("own"), F.explode(F.sequence(band(least), band(n))).alias("band"))
    smallest = F.greatest(least, F.floor(F.pow(F.lit(BAND), "band") * (1 - EPSILON)))
    dealt = dealt.where((n - F.col("place")) * (numerator + denominator) >= (n + smallest) * numerator)
    crowds = dealt.groupBy("shingle", "band").agg(F.count(F.lit(1)).alias("crowd"), F.count_if(F.col("band") == F.col("own")).alias("owners"))
    crowds = staged(crowds.where("crowd > 1 AND owners > 0").drop("owners"), "crowds-by-size")
    return dealt.join(_limited(crowds), ["shingle", "band"]).select(F.xxhash64("shingle", "band").alias("shingle"), "key", "n", "place", "crowd")


def _pairs(members: DataFrame, window: Column) -> DataFrame:
    """Candidate pairs a < b that meet in a region and pass its windows."""
    x = members.select("shingle", F.col("key").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"))
    y = members.select("shingle", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"))
    return x.join(y, "shingle").where(F.col("a") < F.col("b")).where(window).select("a", "b").distinct()


def _sizes_allow(numerator: int, denominator: int) -> Column:
    return F.least("na", "nb") * denominator >= F.greatest("na", "nb") * numerator


def _unsettled(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """cell, key, n, crowd, weight, rest, rest_weight, label, minor of the cells (cell, key, n) that hold several classes; of equal cells one.

    minor: not of the largest class of the cell. A pair that has yet to be found has a minor document in it.
    weight, rest_weight: shingles of all documents of the cell, and of the minor ones, whose number is rest.
    """
    named = cells.join(labels.select(F.col("node").alias("key"), "label"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    classes = named.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("weight"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64(F.lit("again"), "key")).alias("y"))
    sums = classes.groupBy("cell").agg(F.sum("rows").alias("crowd"), F.sum("weight").alias("weight"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.count(F.lit(1)).alias("classes"), F.max(F.struct("rows", "label", "weight")).alias("major"))
    one_each = sums.where("classes > 1").groupBy("crowd", "x", "y").agg(F.min(F.struct("cell", "major", "weight")).alias("one")).select("one.cell", "one.major", "one.weight", "crowd")
    rest = [(F.col("crowd") - F.col("major.rows")).alias("rest"), (F.col("weight") - F.col("major.weight")).alias("rest_weight")]
    return named.join(one_each, "cell").select("cell", "key", "n", "crowd", "weight", *rest, "label", (F.col("label") != F.col("major.label")).alias("minor"))


def _dealt_to_tasks(cells: DataFrame) -> DataFrame:
    """cell, key, label: cells of few minor documents as several that fit into a task each, all with the minor ones."""
    parts = F.ceil(F.greatest((F.col("crowd") - F.col("rest")) * 2 / TASK_CELL, (F.col("weight") - F.col("rest_weight")) * 2 / TASK_SHINGLES))
    part = F.explode(F.when(F.col("minor"), F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("key"), parts)))).alias("part")
    return cells.select("cell", "key", "label", part).select(F.xxhash64("cell", "part").alias("cell"), "key", "label")


def _pivots_of(cells: DataFrame, many: int, level: int) -> DataFrame:
    """cell, p, np: at most ``many`` documents of each cell, minor ones first, then those that are in most cells; maxima, so no cell is gathered."""
    central = cells.groupBy("key").agg(F.count(F.lit(1)).alias("central"))
    order = F.struct("minor", "central", F.xxhash64(F.lit(level), "key").alias("draw"), "key", "n")
    dealt = cells.join(central, "key").select("cell", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(many)).alias("salt"), order.alias("own"))
    return dealt.groupBy("cell", "salt").agg(F.max("own").alias("own")).select("cell", F.col("own.key").alias("p"), F.col("own.n").alias("np"))


def _next_cells(cells: DataFrame, pivots: DataFrame, measured: DataFrame, radius: float, cap: float) -> DataFrame:
    """cell, key, n: the Voronoi cells of ``cells`` with their boundary documents and residuals; see the module."""
    known = measured.select(F.col("u").alias("low"), F.col("v").alias("high"), "far")
    met = cells.join(pivots.select("cell", "p"), "cell").withColumns({"low": F.least("key", "p"), "high": F.greatest("key", "p")})
    met = met.join(known, ["low", "high"], "left").withColumn("far", F.when(F.col("key") == F.col("p"), 0.0).otherwise(F.least(F.coalesce("far", F.lit(cap)), F.lit(cap))))
    each = met.groupBy("cell", "key", "n").agg(F.min("far").alias("least"), F.max(F.col("key") == F.col("p")).alias("is_pivot"), F.collect_list(F.struct("p", "far")).alias("to"))
    each = each.where("NOT is_pivot")
    near = F.filter("to", lambda t: (t["far"] < cap) & (t["far"] - F.col("least") <= 2 * radius + EPSILON))
    rest = F.when(F.col("least") >= cap - radius - EPSILON, F.array(F.struct(F.lit(None).cast("binary").alias("p"), F.col("least").alias("far")))).otherwise(F.array().cast("array<struct<p:binary,far:double>>"))
    each = each.withColumn("into", F.concat(near, rest))
    worth = each.groupBy("cell").agg((F.sum(F.size("into")) <= 2 * F.count(F.lit(1))).alias("parted"))
    placed = each.select("cell", "key", "n", F.explode("into").alias("t")).select("cell", "key", "n", "t.p", "t.far")
    outside = placed.where(F.col("far") > radius + EPSILON).groupBy("cell", "p").agg(F.min("far").alias("nearest"))
    going = placed.alias("x").join(outside.alias("o"), (F.col("x.cell") == F.col("o.cell")) & F.col("x.p").eqNullSafe(F.col("o.p"))).where(F.col("x.far") >= F.col("nearest") - radius - EPSILON)
    parted = going.select("x.cell", "x.key", "x.n", "x.p").join(worth, "cell")
    return parted.select(F.when(F.col("parted"), F.xxhash64("cell", "p")).otherwise(F.col("cell")).alias("cell"), "key", "n").distinct()


def _joined_in_tasks(cells: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """u, v: links between classes within cells (cell, key, label), enough of them to connect whatever links.

    A task holds one cell at a time and counts what its minor documents share with all others by postings.
    """

    def links(keys: list[bytes], labels: list[bytes], own: list[np.ndarray]) -> Iterator[tuple[bytes, bytes]]:
        parent = {label: label for label in labels}

        def root(label: bytes) -> bytes:
            while parent[label] != label:
                parent[label] = parent[parent[label]]
                label = parent[label]
            return label

        sizes = np.array([len(x) for x in own], np.int64)
        values, codes = np.unique(np.concatenate(own), return_inverse=True)
        by_value = np.argsort(codes, kind="stable")
        posted, bounds = np.repeat(np.arange(len(own)), sizes)[by_value], np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(values)))])
        first = np.concatenate([[0], np.cumsum(sizes)])
        major = max(set(labels), key=labels.count)
        for k in (k for k in range(len(keys)) if labels[k] != major):
            lists = [posted[bounds[c] : bounds[c + 1]] for c in codes[first[k] : first[k + 1]].tolist()]
            common = np.bincount(np.concatenate(lists), minlength=len(keys))
            for m in np.flatnonzero(denominator * common >= numerator * (sizes + sizes[k] - common)).tolist():
                x, y = root(labels[k]), root(labels[m])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    yield keys[k], keys[m]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, ([], [], [])

        def solved() -> pa.RecordBatch:
            found = list(links(*held)) if len(set(held[1])) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], names=["u", "v"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cell", "key", "label", "shingles")]
            for here, key, label, data in zip(*columns, strict=True):
                if here != cell:
                    yield solved()
                    cell, held = here, ([], [], [])
                for side, value in zip(held, (key, label, np.frombuffer(data, np.uint64)), strict=True):
                    side.append(value)
        yield solved()

    whole = cells.select("cell", "key", "label").join(sets, "key").repartition("cell").sortWithinPartitions("cell", "key")
    return map_batches(whole.select("cell", "key", "label", "shingles"), join, "u binary, v binary")


def _voronoi_labels(cells: DataFrame, links: DataFrame, sketches: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """node, label of what links within cells (cell, key, n) and by the links given."""
    radius = 1 - numerator / denominator
    cap = min(1.0, CAP_RADII * radius)
    least = max(0, denominator - CAP_RADII * (denominator - numerator))
    level, many, labels = 0, PIVOTS, components(links)
    while True:
        cells = staged(_unsettled(cells, labels), "cells")
        if cells.isEmpty():
            return labels
        fits = (F.col("crowd") <= TASK_CELL) & (F.col("weight") <= TASK_SHINGLES) & F.lit(level > 0)
        few = ~fits & (F.col("rest") <= TASK_CELL // 2) & (F.col("rest_weight") <= TASK_SHINGLES // 2) & F.lit(level > 0)
        in_tasks = cells.where(fits).select("cell", "key", "label").unionByName(_dealt_to_tasks(cells.where(few)))
        found, large = _joined_in_tasks(in_tasks, sets, numerator, denominator), cells.where(~fits & ~few)
        pivots = staged(_pivots_of(large, many, level), "pivots")
        met = large.select("cell", "key", F.col("n").alias("na")).join(pivots.withColumnRenamed("np", "nb"), "cell").where("key != p").where(_sizes_allow(least, denominator))
        met = met.select(F.least("key", "p").alias("a"), F.greatest("key", "p").alias("b")).distinct()
        measured = staged(_measured(_near_in_parts(met, sketches, least, denominator), sets, numerator, denominator), "pivot-distances")
        links = staged(found.unionByName(measured.where("linked").select("u", "v")), "links")
        if not links.isEmpty():
            labels = components(links.unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v"))))
        cells = staged(_next_cells(large, pivots, measured, radius, cap), "next-cells")
        level, many = level + 1, 2 * many


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are runs of anything but ASCII white space, A-Z in lower case. Two rows link when
    denominator * |A & B| >= numerator * |A | B|; rows with equal sets link. component_id is the smallest
    doc_id that links lead to. Null and empty texts have no shingle and link with nothing. Rows with a null
    id link like others; a component of such rows alone has a null component_id. Repeated rows and rows
    that share an id are linked by their texts. An empty table gives no rows; other columns are not read.
    Sets are told apart by 128 bits and compared by 64-bit hashes of shingles. The tables between are
    deleted when the result is written.
    """
    with temporary_tables(docs.sparkSession):
        return staged(_joined(_rows(docs, id_col, text_col), n_words, numerator, denominator), "jaccard-components", outlives=True)


def _joined(rows: DataFrame, n_words: int, numerator: int, denominator: int) -> DataFrame:
    """doc_id, n_shingles, component_id of rows (doc_id, text)."""
    often = frequent_shingles(rows.select("text"), lambda texts: shingle_sets(texts, n_words), "text")
    described = staged(_described(rows, often, n_words, numerator, denominator), "shingle-sets")
    full = described.where("n > 0")
    one_each = full.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id")).alias("first"), F.count(F.lit(1)).alias("rows"))
    firsts = staged(one_each.select("key", F.col("first.doc_id").alias("first_id"), "rows"), "distinct-sets")
    # of rows with equal sets only the first one's (the rows that share its id) are dealt out
    repeats = firsts.where("rows > 1").select("key", "first_id", F.lit(True).alias("repeated"))
    distinct_sets = full.join(_limited(repeats), "key", "left").where(F.col("repeated").isNull() | F.col("doc_id").eqNullSafe(F.col("first_id"))).select("key", "n", "parts", "pivots")
    regions = staged(_regions(distinct_sets), "regions")
    sketches = staged(distinct_sets.join(regions.select("key").distinct(), "key", "left_semi").select("key", "n", "parts").dropDuplicates(["key"]), "part-counts")
    window = _windows(numerator, denominator)
    small = regions.where(F.col("crowd") <= SMALL)
    near = staged(_near_in_parts(_pairs(small, window), sketches, numerator, denominator), "near-pairs")
    in_crowds = staged(regions.where(F.col("crowd") > SMALL).select("key").distinct(), "keys-in-crowds")
    wanted = near.select(F.explode(F.array("a", "b")).alias("key")).unionByName(in_crowds).distinct()
    sets = staged(_whole_sets(rows, staged(wanted.join(firsts.select("key", "first_id"), "key"), "compared-keys"), n_words), "whole-sets")

    # documents that met in crowded regions meet again, by an order that puts last what is frequent among them
    again = sets.join(in_crowds, "key", "left_semi")
    again_often = np.union1d(often, frequent_shingles(again.select("shingles"), _stored_sets, "shingles"))
    regions = staged(_regions(_reordered(again, again_often, numerator, denominator)), "regions-again")
    by_size = staged(_by_size(regions.where(F.col("crowd") > SMALL), numerator, denominator), "regions-by-size")
    small, large = regions.unionByName(by_size).where(F.col("crowd") <= SMALL), by_size.where(F.col("crowd") > SMALL)
    pairs = _pairs(small, window).join(near, ["a", "b"], "left_anti")
    links = staged(_linked(near.unionByName(_near_in_parts(pairs, sketches, numerator, denominator)), sets, numerator, denominator), "links")
    labels = _voronoi_labels(large.select(F.col("shingle").alias("cell"), "key", "n"), links, sketches, sets, numerator, denominator)
    merged = firsts.join(labels.select(F.col("node").alias("key"), "label"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    names = staged(merged.groupBy("label").agg(F.min("first_id").alias("component_id")), "component-names")
    by_key = staged(merged.select("key", "label").join(names, "label").select("key", "component_id"), "component-of-set")
    apart = described.where("n = 0").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return described.where("n > 0").select("doc_id", "key", "n").join(by_key, "key").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id").unionByName(apart)


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one row of each component: that of the smallest id, of equal ids by a hash of the text; null ids come last.

    Rows are told apart by a number of their own, so shared and null ids neither lose a text nor keep a copy.
    """
    numbered = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows")
    found = jaccard_components(numbered, "__row", text_col, **options).select(F.col("doc_id").alias("__row"), "component_id")
    own_id = F.col(id_col).cast("long")
    order = F.struct(own_id.isNull().alias("null_id"), own_id.alias("id"), F.xxhash64(text_col).alias("hash"), F.col("__row").alias("row"))
    members = staged(found.join(numbered.select("__row", order.alias("order")), "__row"), "component-rows")
    copies = members.where("__row != component_id").select("component_id").distinct()
    several = members.join(copies, "component_id", "left_semi")
    kept = several.groupBy("component_id").agg(F.min("order")["row"].alias("__row"))
    dropped = staged(several.select("__row").join(kept.select("__row"), "__row", "left_anti"), "near-copies")
    return numbered.join(dropped, "__row", "left_anti").select(*docs.columns)
