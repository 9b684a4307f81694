"""The trie of conversations that share their first turns.

A node is a distinct sequence of first turns. It is named by its depth and the exclusive or of 128-bit
hashes of its turns with their depths, which adds up along a conversation in any order, so paths of any
length are hashed in chunks. Each task combines the nodes of its own conversations into a partial trie;
partial tries are merged by node in two levels, which adds members and takes the smallest one. The nodes
that one conversation is the smallest member of are the end of its path, one chain; the rollup adds up
each chain from its end to its top, and passes a chain's total on to what lies above it on its path. Lists
of members that end at a node travel as sorted chunks and are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import map_batches, staged
from textloom.operators.ordinals import with_ordinals, with_running

#: Conversations are grouped by this many ids, and share up to SHARED_TURNS - 1 turns of the first of them.
GROUP, SHARED_TURNS = 100, 6
#: A node's partial counts meet in this many branches before they meet at the node.
BRANCHES = 64
#: Ids in one chunk of a list of ends.
CHUNK_IDS = 1 << 14
NODE = ["depth", "k1", "k2"]


def turn_rows(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 1), digest of role and text, chars of the text: what the trie needs of each turn."""
    own_role, own_text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    digest = F.md5(F.concat(F.char_length(own_role).cast("string"), F.lit(":"), own_role, own_text))
    slim = turns.where(F.col(conversation).isNotNull()).select(F.col(conversation).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"), F.char_length(own_text).cast("long").alias("chars"))
    return with_ordinals(slim, ["conv_id"], [F.asc_nulls_first("turn"), "digest"], "place", keep=lambda df: staged(df, "ordered-turns")).drop("turn")


def rebuilt(turns: DataFrame, group: int = GROUP, shared: int = SHARED_TURNS) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, depth, digest, chars) once they start with turns of their group's first conversation.

    A conversation takes the first crc32(id) % shared turns of conversation id - id % group (as many as
    there are), then its own after as many.
    """
    own_len = turns.groupBy("conv_id").agg(F.max("place").alias("own_len"))
    convs = own_len.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    bases = own_len.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("own_len").alias("base_len"))
    taken = F.least(F.col("h"), F.coalesce("base_len", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken).withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("own_len") - F.col("h")))
    convs = staged(convs.select("conv_id", "base", "h", "taken", "length"), "conversations")
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("place") < shared)).select(F.col("conv_id").alias("base"), "place", "digest", "chars")
    first = convs.join(heads, "base").where("place <= taken").select("conv_id", F.col("place").alias("depth"), "digest", "chars")
    rest = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place > h").select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "digest", "chars")
    return convs.select("conv_id", "length"), first.unionByName(rest)


def paths(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2 (the node), p1, p2 (the node above it), chars, last: a row for each node that a conversation passes, the root too."""
    own = turns.withColumn("t1", F.xxhash64("depth", "digest")).withColumn("t2", F.xxhash64("digest", "depth"))
    keyed = with_running(own, "conv_id", "depth", {"k1": F.col("t1"), "k2": F.col("t2")}, F.bit_xor)
    ended = keyed.join(convs, "conv_id").withColumn("last", F.col("depth") == F.col("length"))
    below = ended.select("conv_id", F.col("depth").cast("long").alias("depth"), "k1", "k2", F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"), "chars", "last")
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), zero.alias("chars"), (F.col("length") == 0).alias("last"))
    return below.unionByName(root)


def _merged(rows: DataFrame, names: list[str], **merges) -> DataFrame:
    """rows combined by name: within each task, then in BRANCHES by task, then whole. merges: new column = (aggregate, column), of a kind that can be merged again."""
    partial = rows.groupBy(*names, F.pmod(F.spark_partition_id(), F.lit(BRANCHES)).alias("branch")).agg(*[f(c).alias(n) for n, (f, c) in merges.items()])
    return partial.groupBy(*names).agg(*[f(n).alias(n) for n, (f, _) in merges.items()])


def trie_nodes(passed: DataFrame) -> DataFrame:
    """depth, k1, k2, p1, p2, chars, conv_id (smallest member), n_convs of each node."""
    return _merged(passed.withColumn("one", F.lit(1).cast("long")), NODE, p1=(F.max, "p1"), p2=(F.max, "p2"), chars=(F.max, "chars"), conv_id=(F.min, "conv_id"), n_convs=(F.sum, "one"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation to runs of decimal ids of one node."""
    for batch in batches:
        names = np.stack([batch.column(c).to_numpy() for c in NODE])
        ids = batch.column("conv_id").to_pylist()
        fresh = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1 if len(ids) else []
        bounds = [0, *fresh, len(ids)]
        bounds = [x for a, b in zip(bounds[:-1], bounds[1:], strict=True) for x in range(a, b, CHUNK_IDS)] + [len(ids)]
        if len(bounds) > 1:
            starts = np.array(bounds[:-1])
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x[starts]) for x in names] + [batch.column("conv_id").take(pa.array(starts)), pa.array(texts, pa.string())], names=[*NODE, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by node and first id to the SHA-256 of each node's whole list; a list is never held whole."""
    node, digest = None, None

    def row(found: list) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"])

    for batch in batches:
        done = []
        for *own, ids in zip(*[batch.column(c).to_pylist() for c in NODE], batch.column("ids").to_pylist(), strict=True):
            if own != node:
                if digest:
                    done.append((*node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield row(done)
    if digest:
        yield row([(*node, digest.hexdigest())])


def end_lists(passed: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 of nodes where conversations end.

    Conversations are dealt into ranges of ids, each range gives sorted chunks for each node, and a node's
    chunks are hashed in order. SHA-256 is one chain, so a list is hashed in one task, but as a stream.
    """
    ends = passed.where("last").select(*NODE, "conv_id").repartitionByRange("conv_id").sortWithinPartitions(*NODE, "conv_id")
    chunks = map_batches(ends, _chunks, "depth long, k1 long, k2 long, first long, ids string")
    return map_batches(chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first"), _digests, "depth long, k1 long, k2 long, ends_sha256 string")


def rollup(nodes: DataFrame, passed: DataFrame) -> DataFrame:
    """depth, k1, k2, n_leaves, saved_tokens of each node's subtree. nodes: also n_children, own_saved."""
    values = {"saved": F.col("own_saved"), "leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")}
    chain = staged(with_running(nodes.withColumn("upward", -F.col("depth")), "conv_id", "upward", values), "chains")
    tops = chain.groupBy("conv_id").agg(F.min("depth").alias("top"), F.max("saved").alias("total_saved"), F.max("leaves").alias("total_leaves")).where("total_saved > 0 OR total_leaves > 0")
    above = passed.select("conv_id", *NODE).join(tops, "conv_id").where("depth < top")
    passed_on = _merged(above, NODE, more_saved=(F.sum, "total_saved"), more_leaves=(F.sum, "total_leaves"))
    joined = chain.join(passed_on, NODE, "left")
    return joined.select(*NODE, (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"))


def _on(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(x) == F.col(y) for x, y in zip(a, b, strict=True)])


def conversation_trie(conversations: DataFrame, group: int = GROUP, shared: int = SHARED_TURNS, **columns) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are taken in order of turn, null first; turns that tie come in the order of the MD5 of role and
    text, repeated rows are turns of their own. Null role or text is empty. Rows without conv_id are in no
    conversation. Ids are told from their group by the remainder as SQL has it (-5 is in group 0). An empty
    table gives no row, not even a root. Other columns are ignored.

    Texts are never shuffled: a turn is 60 bytes or so after its table is read. No task holds a
    conversation or a node's members: see with_ordinals, with_running and end_lists.
    """
    turns = staged(turn_rows(conversations, **columns), "numbered-turns")
    convs, own = rebuilt(turns, group, shared)
    passed = staged(paths(convs, own), "paths")
    nodes = staged(trie_nodes(passed), "nodes")
    below = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.lit(1).cast("long").alias("one"))
    children = _merged(below, NODE, n_children=(F.sum, "one"))
    whole = nodes.join(children, NODE, "left").select("conv_id", *NODE, "p1", "p2", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"))
    whole = staged(whole, "counted-nodes")
    parents = nodes.select((F.col("depth") + 1).alias("d"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    found = whole.join(rollup(whole, passed), NODE).join(end_lists(passed), NODE, "left").join(parents, _on(["depth", "p1", "p2"], ["d", "u1", "u2"]), "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
