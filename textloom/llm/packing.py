"""Packing documents into sequences of a fixed number of tokens.

Documents become ids, and those longer than a sequence are cut. Which lengths share a sequence is decided
on the number of pieces of each length alone, of which there are no more than a sequence has tokens:
sums of one, two and three lengths are indexed, and combinations that fill a gap exactly are used as often
as the counts allow; what is left is packed by best fit, longest first, all sequences of one content at
once. Each piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from textloom.llm.common import map_batches, staged, text_or_empty
from textloom.llm.wordbatch import SPACE, binary_parts, distinct, flat, ragged_take, regrouped

END_ID, CAPACITY = 2, 1024
BATCH_BYTES = 6 << 20
#: The library gets this many bytes of distinct words at once.
GROUP_BYTES = 1 << 18
#: Distinct stretches that a worker remembers with their ids.
KNOWN_WORDS = 400_000
#: ASCII letters, digits and what else is visible; 0: white space, controls and all other bytes.
KIND = np.zeros(256, np.uint8)
KIND[[*range(65, 91), *range(97, 123)]] = 1
KIND[[*range(48, 58)]] = 2
KIND[[b for b in range(33, 127) if not KIND[b]]] = 3


def _maybe_space(raw: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether characters that end at these bytes may be white space beyond ASCII: those of 2 bytes start with C2, those of 3 with E1, E2 or E3."""
    two, three = raw[np.maximum(last - 1, 0)], raw[np.maximum(last - 2, 0)]
    return (raw[last] >= 0x80) & ((two == 0xC2) | (three == 0xE1) | (three == 0xE2) | (three == 0xE3))


class ByteLevelEncoder:
    """Encodes texts with a byte-level BPE tokenizer that parts text into letters, digits, other signs and white space.

    Its pattern looks back at nothing, so a text may be cut wherever a part is sure to end: before ASCII
    white space after anything else, and between ASCII letters, digits and other signs, but for the
    apostrophe, which may open a contraction. Each distinct stretch of a batch is encoded once, and the first
    ``KNOWN_WORDS`` of them are kept for later batches; many stretches are encoded as one string, whose ids
    are told apart by the bytes that each id stands for.
    """

    def __init__(self, tokenizer_path: str):
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.n_bytes[i] = len(token)  # one character a byte
        for i, t in self.tokenizer.get_added_tokens_decoder().items():
            self.n_bytes[i] = len(t.content.encode())
        self.known = pa.array([], pa.large_binary())
        self.known_ids, self.known_off = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct stretches end to end, and their offsets."""
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(pc.is_null(at))
        values, off = self._encode_words(new)
        place = at.fill_null(-1).to_numpy().copy()
        place[place < 0] = len(self.known) + np.arange(len(new))
        ids, bounds = np.concatenate([self.known_ids, values]), np.concatenate([self.known_off, self.known_off[-1] + off[1:]])
        if room := min(len(new), max(0, KNOWN_WORDS - len(self.known))):
            n = len(self.known) + room
            self.known = pa.concat_arrays([self.known, new.slice(0, room)])
            self.known_ids, self.known_off = ids[: bounds[n]].copy(), bounds[: n + 1].copy()
        return ragged_take(ids, bounds, place)

    def bounds(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where stretches start; one starts with each text that is not empty."""
        space = SPACE[raw]
        cut = np.zeros(len(raw) + 1, bool)
        ends = ~space
        last = np.flatnonzero((raw[:-1] >= 0x80) & space[1:])
        ends[last[_maybe_space(raw, last)]] = False
        cut[1:-1] = space[1:] & ends[:-1]
        if not any(s in raw.tobytes() for s in self.special):
            kind = KIND[raw]
            cut[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & (raw[:-1] != 39)
        cut[off] = True
        return np.flatnonzero(cut[:-1])

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct stretches end to end, and their offsets."""
        raw, off = binary_parts(words)
        n = off[1:] - off[:-1]
        first_byte, last = raw[off[:-1]], off[1:] - 1
        led = ~SPACE[first_byte]  # gets a line end before it, which stays one id by itself before what is no white space
        alone = SPACE[raw[last]] | _maybe_space(raw, last) | np.isin(first_byte, [0xC2, 0xE1, 0xE2, 0xE3])  # white space that would join its neighbour's
        ids: list[np.ndarray] = []
        lengths = np.zeros(len(words), np.int64)
        joined = np.flatnonzero(~alone)
        group = np.cumsum(n[joined]) // GROUP_BYTES
        texts = words.cast(pa.large_string())
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        for at in np.split(joined, np.flatnonzero(np.diff(group)) + 1) if len(joined) else []:
            own = pc.binary_join_element_wise(pa.array(np.where(led[at], "\n", ""), pa.large_string()), texts.take(pa.array(at)), pa.scalar("", pa.large_string()))
            got = np.array(self.tokenizer.encode_batch_fast(["".join(own.to_pylist())], add_special_tokens=False)[0].ids, np.int64)
            place = np.cumsum(self.n_bytes[got])
            stop = np.cumsum(n[at] + led[at])
            last = np.searchsorted(place, stop)
            first = np.concatenate([[0], last[:-1] + 1])
            if not (np.array_equal(place[last], stop) and np.all(got[first[led[at]]] == newline)):
                raise ValueError("the tokenizer doesn't part text as a byte-level one does")
            keep = np.ones(len(got), bool)
            keep[first[led[at]]] = False
            ids.append(got[keep].astype("<u4"))
            lengths[at] = last + 1 - first - led[at]
        rest = np.flatnonzero(alone)
        for k in range(0, len(rest), 2000):
            got = [x.ids for x in self.tokenizer.encode_batch_fast(texts.take(pa.array(rest[k : k + 2000])).to_pylist(), add_special_tokens=False)]
            lengths[rest[k : k + 2000]] = [len(x) for x in got]
            ids += [np.array(x, "<u4") for x in got]
        order = np.concatenate([joined, rest])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        stored = np.zeros(len(order) + 1, np.int64)
        np.cumsum(lengths[order], out=stored[1:])
        return ragged_take(np.concatenate(ids) if ids else np.zeros(0, "<u4"), stored, place)

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each text closed by end_id, and the offsets of each text in them."""
        raw, off = flat(texts)
        starts = self.bounds(raw, off) if len(raw) else np.zeros(0, np.int64)
        codes, words = distinct(raw, starts, np.append(starts[1:], len(raw)))
        values, bounds = self.words(words)
        last = np.searchsorted(starts, off[1:], "left")
        out, word_off = ragged_take(np.append(values, np.uint32(end_id)), np.append(bounds, bounds[-1] + 1), np.insert(codes, last, len(words)))
        return out, word_off[np.concatenate([[0], last + np.arange(len(last)) + 1])]


@functools.cache
def encoder_of(tokenizer_path: str) -> ByteLevelEncoder:
    """One encoder a worker, which keeps its known words from task to task."""
    return ByteLevelEncoder(tokenizer_path)


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, rank long"


def _cutter(tokenizer_path: str, capacity: int, end_id: int, batch_bytes: int, with_ids: bool):
    """mapInArrow function: documents to pieces, each with its rank among those of its length in this task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in regrouped(batches, "text", batch_bytes):
            ids, off = encoder_of(tokenizer_path)(batch.column("text"), end_id)
            n = off[1:] - off[:-1]
            pieces = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = (n - (pieces - 1) * capacity)[doc]
            start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
            length = np.where(piece == 0, first, capacity)
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=capacity + 1)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) + (seen - (np.cumsum(counts) - counts))[length[order]]
            seen += counts
            data, at = memoryview(ids.astype("<u4").tobytes()), 4 * (off[doc] + start)
            spans = [data[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length, pa.int32()), pa.array([zlib.crc32(x) for x in spans], pa.int64()), pa.array(np.full(len(doc), part, np.int32)), pa.array(rank)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array([bytes(x) for x in spans], pa.binary())] if with_ids else []), names + ["ids"] * with_ids)

    return cut


class Combinations:
    """Sums of one, two and three lengths, and how many pieces of each length are left.

    A sum's pairs are listed when it is first asked for, the longer length first and descending; a pair
    leaves the list when one of its lengths is used up. A triple is a length with the pairs of the rest.
    """

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self._pairs: dict[int, list[tuple[int, int]]] = {}

    def often(self, lengths: tuple[int, ...]) -> int:
        """Times that all these lengths can be taken together."""
        return min(int(self.left[x]) // lengths.count(x) for x in lengths)

    def pairs(self, total: int) -> Iterator[tuple[int, int]]:
        found = self._pairs.get(total)
        if found is None:
            longer = np.arange(total - 1, (total - 1) // 2, -1)
            longer = longer[(self.left[longer] > 0) & (self.left[total - longer] > 0)]
            found = self._pairs[total] = [(x, total - x) for x in longer.tolist()]
        self._pairs[total] = found = [p for p in found if self.left[p[0]] and self.left[p[1]]]
        return iter(found)

    def filling(self, gap: int) -> Iterator[tuple[int, ...]]:
        """Combinations of exactly this sum: the single length, then pairs, then triples, long lengths first; nothing fills no gap."""
        if not gap:
            yield ()
        elif self.left[gap]:
            yield (gap,)
        yield from self.pairs(gap)
        for longest in range(gap - 2, (gap - 1) // 3, -1):
            if self.left[longest]:
                for pair in self.pairs(gap - longest):
                    if pair[0] <= longest:
                        yield (longest, *pair)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.left[x] -= times


def pack_lengths(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Contents of sequences and how many sequences have each: ([(length, pieces), ...], sequences).

    counts: pieces of each length from 0 to capacity (length 0 must have none). Every step uses up a length
    or fills all sequences of one content, so there are few contents however many pieces there are. Short
    lengths fill what no sum fills exactly, so those below some length are held back for the best fit; which
    length, is tried in 32 steps, and the least number of sequences decides.
    """
    tried = (_exact_then_best_fit(counts, capacity, held) for held in range(0, max(1, capacity // 2), max(1, capacity // 64)))
    return min(tried, key=lambda contents: sum(n for _, n in contents))


def _exact_then_best_fit(counts: np.ndarray, capacity: int, held: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences filled exactly by lengths of ``held`` or more, then the best fit of all that is left."""
    index, contents = Combinations(np.where(np.arange(len(counts)) < held, 0, counts)), []
    for longest in range(capacity, 0, -1):
        for rest in index.filling(capacity - longest) if index.left[longest] else ():
            if times := index.often(lengths := (longest, *rest)):
                contents.append(([(x, 1) for x in lengths], times))
                index.take(lengths, times)
                if not index.left[longest]:
                    break
    return contents + _best_fit(index.left + np.where(np.arange(len(counts)) < held, counts, 0), capacity)


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Longest pieces first, each into the fullest sequence that it fits into; sequences of one content go together."""
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    gaps: list[int] = []  # ascending

    def put(gap: int, content: list[tuple[int, int]], sequences: int) -> None:
        if gap not in open_:
            open_[gap] = []
            bisect.insort(gaps, gap)
        open_[gap].append((content, sequences))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(gaps, length)
            gap = gaps[at] if at < len(gaps) else capacity
            each = gap // length
            if at < len(gaps):
                content, there = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap], gaps[at]
            else:
                content, there = [], max(1, left // each)
            filled = min(there, left // each)
            if filled:
                put(gap - each * length, [*content, (length, each)], filled)
                left -= filled * each
            else:  # fewer pieces than one sequence takes
                filled = 1
                put(gap - left * length, [*content, (length, left)], 1)
                left = 0
            if content and there > filled:
                put(gap, content, there - filled)
    return [x for own in open_.values() for x in own]


def _places(contents: list[tuple[list[tuple[int, int]], int]], capacity: int) -> np.ndarray:
    """Ranks of each length to places: a row per run of ranks, sorted by length and first rank."""
    used, sequence, rows = np.zeros(capacity + 1, np.int64), 0, []
    for content, sequences in contents:
        offset = 0
        for length, each in content:
            rows.append((length, used[length], sequence, each, offset))
            used[length] += each * sequences
            offset += length * each
        sequence += sequences
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placer(places: np.ndarray, with_ids: bool):
    """mapInArrow function: pieces with their rank among all of their length to their sequence and offset there."""
    keys = (places[:, 0] << 44) + places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            _, first, sequence, each, offset = places[np.searchsorted(keys, (length << 44) + rank, "right") - 1].T
            own = [batch.column(c) for c in ("doc_id", "piece", "start")] + [pa.array(length), batch.column("ids_crc32"), pa.array(sequence + (rank - first) // each), pa.array(offset + (rank - first) % each * length)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(own + ([batch.column("ids")] if with_ids else []), names + ["ids"] * with_ids)

    return place


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; with_ids adds the ids as little-endian 32-bit integers.

    Null text is empty and has the end id alone. A document of more than ``capacity`` ids is cut into
    pieces of ``capacity``, of which the first may be shorter. Rows of a null or repeated id are documents
    of their own; which of two pieces of one length goes where is decided by their order in the table as
    read. An empty table gives no row. Other columns of docs are ignored.

    Texts are read once and never shuffled. Pieces are written with their rank in their task, so the rank
    among all of a length needs only counts by task and length; the driver sees one count a length.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    pieces = staged(map_batches(rows, _cutter(tokenizer_path, capacity, end_id, batch_bytes, with_ids), PIECES + ", ids binary" * with_ids), "pieces")
    counts = staged(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    by_length = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        by_length[r["length"]] = r["n"]
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.join(counts.select("part", "length", before.alias("before")), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")
    places = _places(pack_lengths(by_length, capacity), capacity)
    return map_batches(ranked, _placer(places, with_ids), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids binary" * with_ids)


def packed_sequences(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """A row per sequence: sequence_id, n_tokens, doc_ids and lengths in order, ids (little-endian 32-bit integers). A sequence has at most ``capacity`` pieces."""
    packed = pack_documents(docs, tokenizer_path, with_ids=True, **options)
    own = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("own"))
    joined = F.aggregate("own", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return own.select("sequence_id", F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"), F.col("own.doc_id").alias("doc_ids"), F.col("own.length").alias("lengths"), joined.alias("ids"))
