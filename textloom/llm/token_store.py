"""Token ids in binary shards: one zstandard frame a document, all under one shared dictionary.

A shard file is: MAGIC, SHA-256 of the dictionary, the frames end to end, then the index (per document
doc_id, presence of the id, frame offset, frame length, number of ids), and a tail with the index offset
and the number of documents. Any document is read with the index and one frame. Shards hold ascending
ranges of doc_id. Beside the shards lie the dictionary and the manifest, which has for each shard how many
ids precede it; it is written last, so a folder with a manifest is whole.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from textloom.llm.common import map_batches, text_or_empty, work_dir
from textloom.llm.wordbatch import SPACE, distinct, flat, ragged_take, regrouped, word_bounds

MAGIC = b"TLIDS001"
DICTIONARY, MANIFEST_FILE = "dictionary.zstd", "manifest.json"
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("length", "<u4"), ("n_ids", "<u8")])
TAIL, TAIL_BYTES = "<QQ", 16
END_ID = 2
#: The dictionary is trained on about this many documents of at most this many bytes each.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1500, 20_000, 64_000
BATCH_BYTES = 8 << 20
WORD_GROUP = 2_000
PLAIN = "^[a-zÀ-ÖØ-öø-ÿ]+$"
#: 1: ASCII letters and digits; 2: ASCII punctuation but the apostrophe; 0: the rest.
KIND = np.zeros(256, np.uint8)
KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
KIND[[b for b in range(33, 127) if not KIND[b] and b != 39]] = 2


class WordwiseEncoder:
    """Encodes texts with a tokenizer that lower-cases and whose pre-tokenizer parts words at white space and punctuation.

    A batch falls apart into runs that such a tokenizer treats alone, and each distinct run is encoded
    once. Runs end at ASCII white space, and between an ASCII letter or digit and ASCII punctuation other
    than an apostrophe (which may open a contraction). A-Z are lower-cased before, unless what follows is
    no ASCII, since an accent may join them first. A batch with a special token's string is parted at white
    space only, in its own case.
    """

    def __init__(self, tokenizer_path: str):
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bare = Tokenizer(self.tokenizer.model)  # the same model, without normalizer and pre-tokenizer
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or "</w>"
        self.word_end = np.array([(self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(self.tokenizer.get_vocab_size())])
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}

    def runs(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes to encode, and the starts and ends of the runs."""
        inside = ~SPACE[raw]
        after = np.append(raw[1:], 0)
        after[off[1:][off[1:] > 0] - 1] = 0
        lowered = np.where((raw >= 65) & (raw <= 90) & (after < 128), raw + 32, raw).astype(np.uint8)
        if any(s in (joined := lowered.tobytes()) for s in self.special):
            return raw, *word_bounds(raw, off, inside)
        del joined
        kind = KIND[lowered]
        apart = np.zeros(len(raw) + 1, bool)
        apart[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        return lowered, *word_bounds(lowered, off, inside, breaks=apart)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct runs end to end, and their offsets.

        Runs of Latin-1 letters are their own normal form once lower-cased, so they go straight to the
        library's model as one pre-tokenized sequence; an id whose token ends a word parts them.
        """
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        ids: list[np.ndarray] = []
        lengths = np.zeros(len(words), np.int64)
        for mask, encode in ((plain, self._encode_plain), (~plain, self._encode_any)):
            at = np.flatnonzero(mask)
            own = words.take(pa.array(at)).to_pylist()
            for k in range(0, len(own), WORD_GROUP):  # the library's own results are large: a group at a time
                got, n = encode(own[k : k + WORD_GROUP])
                ids.append(got)
                lengths[at[k : k + WORD_GROUP]] = n
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        stored = np.zeros(len(order) + 1, np.int64)
        np.cumsum(lengths[order], out=stored[1:])
        return ragged_take(np.concatenate(ids) if ids else np.zeros(0, "<u4"), stored, place)

    def _encode_any(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        n = [len(x) for x in ids]
        return np.fromiter(chain.from_iterable(ids), "<u4", sum(n)), n

    def _encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        spelled = "\n".join(words).lower().translate(self.spelling).split("\n")
        ids = np.array(self.bare.encode_batch_fast([spelled], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(ids)):
            return self._encode_any(words)
        return ids, np.diff(ends, prepend=0)

    def __call__(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of each text in them."""
        raw, off = flat(texts)
        data, starts, ends = self.runs(raw, off)
        codes, words = distinct(data, starts, ends)
        values, bounds = self.encode_words(words.cast(pa.large_string()))
        if end_id is not None:
            values, bounds = np.append(values, np.uint32(end_id)), np.append(bounds, bounds[-1] + 1)
        last = np.searchsorted(starts, off[1:], "left")  # runs before each text's end
        order = np.insert(codes, last, len(words)) if end_id is not None else codes
        out, word_off = ragged_take(values, bounds, order)
        return out, word_off[np.concatenate([[0], last + (np.arange(len(last)) + 1 if end_id is not None else 0)])]


def train_dictionary(docs: DataFrame, tokenizer_path: str, text_col: str, id_col: str) -> bytes:
    """A zstandard dictionary from the id arrays of a bounded, hash-chosen sample of short documents; b"" if too few."""
    every = max(1, docs.count() // SAMPLE_DOCS)
    chosen = docs.where((F.pmod(F.xxhash64(F.col(id_col)), F.lit(every)) == 0) & (F.octet_length(text_or_empty(text_col)) <= SAMPLE_BYTES))
    texts = sorted(r[0] for r in chosen.select(text_or_empty(text_col)).limit(2 * SAMPLE_DOCS).collect())
    if not texts:
        return b""
    ids, off = WordwiseEncoder(tokenizer_path)(pa.array(texts, pa.large_string()), END_ID)
    samples = [ids[a:b].tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]
    if len(samples) < 100 or sum(map(len, samples)) < 10 * 4096:
        return b""
    return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 10), samples).as_bytes()


def _compression(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def shard_writer(folder: str, tokenizer_path: str, dictionary: bytes, batch_bytes: int):
    """mapInArrow function: a partition sorted by doc_id becomes one shard; returns the shard's manifest row."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, store, root = None, None, None
        index, at, tokens = [], len(MAGIC) + 32, 0
        shard = TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(level=3, dict_data=_compression(dictionary))
        for batch in regrouped(batches, "text", batch_bytes):
            if encoder is None:
                encoder = WordwiseEncoder(tokenizer_path)
                store, root = fs.FileSystem.from_uri(folder)
                store.create_dir(root, recursive=True)
                draft = f"{root}/draft-{shard:06d}-{uuid.uuid4().hex}"
                out = store.open_output_stream(draft)
                out.write(MAGIC + hashlib.sha256(dictionary).digest())
            ids, off = encoder(batch.column("text"), END_ID)
            frames = [packer.compress(ids[a:b].tobytes()) for a, b in zip(off[:-1], off[1:], strict=True)]
            doc_ids = batch.column("doc_id")
            rows = np.zeros(len(frames), INDEX)
            rows["doc_id"] = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
            rows["has_id"] = doc_ids.is_valid().to_numpy(zero_copy_only=False)
            rows["length"] = [len(x) for x in frames]
            rows["offset"] = at + np.concatenate([[0], np.cumsum(rows["length"].astype(np.int64))[:-1]])
            rows["n_ids"] = np.diff(off)
            at += int(rows["length"].sum())
            tokens += len(ids)
            out.write(b"".join(frames))
            index.append(rows)
        if encoder is None:
            return
        index = np.concatenate(index)
        out.write(index.tobytes() + struct.pack(TAIL, at, len(index)))
        out.close()
        name = f"ids-{shard:06d}.bin"
        store.move(draft, f"{root}/{name}")  # the same name and bytes from every attempt
        yield pa.RecordBatch.from_pylist([{"shard": shard, "name": name, "n_docs": len(index), "n_ids": tokens, "n_bytes": at}], schema=MANIFEST)

    return write


MANIFEST = pa.schema([("shard", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
MANIFEST_SQL = "shard int, name string, n_docs long, n_ids long, n_bytes long"


class Shard:
    """Random access to one shard file."""

    def __init__(self, path: str, dictionary: bytes):
        store, where = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(where)
        head = self.file.read_at(len(MAGIC) + 32, 0)
        if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) :] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} is no shard under this dictionary")
        size = self.file.size()
        at, n = struct.unpack(TAIL, self.file.read_at(TAIL_BYTES, size - TAIL_BYTES))
        self.index = np.frombuffer(self.file.read_at(n * INDEX.itemsize, at), INDEX)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_compression(dictionary))

    def ids(self, row: int) -> np.ndarray:
        x = self.index[row]
        return np.frombuffer(self._unpack(self.file.read_at(int(x["length"]), int(x["offset"])), int(x["n_ids"])), "<u4")

    def _unpack(self, frame: bytes, n_ids: int) -> bytes:
        return self.unpacker.decompress(frame, max_output_size=4 * n_ids)

    def scan(self, block: int = 4096) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Blocks of index rows with their id bytes, read a block at a time."""
        for k in range(0, len(self.index), block):
            rows = self.index[k : k + block]
            first = int(rows["offset"][0])
            data = self.file.read_at(int(rows["offset"][-1] + rows["length"][-1]) - first, first)
            yield rows, [self._unpack(data[o : o + n], m) for o, n, m in zip((rows["offset"] - first).tolist(), rows["length"].tolist(), rows["n_ids"].tolist(), strict=True)]


def _write_file(folder: str, name: str, data: bytes) -> None:
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/{name}") as out:
        out.write(data)


def _read_file(folder: str, name: str) -> bytes:
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/{name}") as file:
        return file.read()


class TokenStore:
    """A written store: folder, dictionary, and a manifest with each shard's first id position, all read from the folder."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder, self.dictionary = spark, folder, _read_file(folder, DICTIONARY)
        self.manifest = [(x["shard"], x["name"], x["start"]) for x in json.loads(_read_file(folder, MANIFEST_FILE))]

    @classmethod
    def open(cls, folder: str, spark=None) -> TokenStore:
        """The store in a folder, whoever wrote it; shards can be read without Spark, the digest cannot."""
        return cls(spark or SparkSession.getActiveSession(), folder)

    def shard(self, k: int) -> Shard:
        return Shard(f"{self.folder}/{self.manifest[k][1]}", self.dictionary)

    def digest(self) -> DataFrame:
        """Per document, from the files: doc_id, start, n_tokens, ids_crc32, frame_bytes."""
        folder = self.folder
        shards = self.spark.createDataFrame(self.manifest, "shard int, name string, start long")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dictionary = None
            for batch in batches:
                for x in batch.to_pylist():
                    dictionary = _read_file(folder, DICTIONARY) if dictionary is None else dictionary
                    start = x["start"]
                    for rows, ids in Shard(f"{folder}/{x['name']}", dictionary).scan():
                        n = rows["n_ids"].astype(np.int64)
                        ends = start + np.cumsum(n)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(rows["doc_id"].copy(), mask=rows["has_id"] == 0), pa.array(ends - n), pa.array(n), pa.array([zlib.crc32(b) for b in ids], pa.int64()), pa.array(rows["length"].astype(np.int64))],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "frame_bytes"],
                        )
                        start = int(ends[-1])

        return shards.repartition(max(1, len(self.manifest))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, frame_bytes long")


def write_token_store(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> TokenStore:
    """Write docs as token-id shards, ascending by doc_id, into a fresh folder of the shared folder.

    Null text is empty and gives the end id alone; rows with a null id come first; of rows with one id
    the smaller text comes first, and repeated rows are all written. An empty table gives no shard. A
    shard holds what Spark deals to one partition and is written batch by batch, so memory stays bounded.
    """
    spark, folder = docs.sparkSession, work_dir(docs.sparkSession, "token-store")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    dictionary = train_dictionary(rows, tokenizer_path, "text", "doc_id")
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    _write_file(folder, DICTIONARY, dictionary)
    shards = map_batches(ranged, shard_writer(folder, tokenizer_path, dictionary, batch_bytes), MANIFEST_SQL).collect()
    manifest, start = [], 0
    for row in sorted(shards, key=lambda r: r["shard"]):
        manifest.append(row.asDict() | {"start": start})
        start += row["n_ids"]
    _write_file(folder, MANIFEST_FILE, json.dumps(manifest).encode())
    return TokenStore(spark, folder)
