import hashlib
import random
import zlib

import pytest

from textloom.llm import prefix_trie as op
from textloom.operators import ordinals

SCHEMA = "conv_id long, turn int, role string, text string, depth string, k1 string, place int, digest string, chars string, last string"


def table_of(spark, data):
    return spark.createDataFrame([(*r, "a", "b", 3, "d", "e", "f") for r in data], SCHEMA)


def brute(data, group=100, shared=6):
    turns = {}
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for conv, turn, role, text in data:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in turns.items()}
    members, ends = {}, {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % shared
        remainder = c % group if c >= 0 else -(-c % group)
        path = tuple(own.get(c - remainder, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children, leaves, saved = {}, {}, {}
    for k in members:
        if k:
            children[k[:-1]] = children.get(k[:-1], 0) + 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] = leaves.get(k[:d], 0) + (k not in children)
            saved[k[:d]] = saved.get(k[:d], 0) + ((len(m) - 1) * len(k[-1][1]) if k else 0)
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children.get(k, 0), leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()) for k, m in members.items())


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.collect())


def test_query_equals_brute_force(spark):
    from textloom.llm.registry import op12_prefix_trie

    folder = "/root/testdata/sf0.01"
    table = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert got(op12_prefix_trie(spark, folder)) == brute(table)


@pytest.mark.parametrize("seed", [1, 2])
def test_nulls_ties_repeats_and_turnless(spark, seed):
    rng = random.Random(seed)
    some = lambda: rng.choice([None, "", "a", "b", "ü😀", "long " * 9])
    data = [(rng.choice([None, 0, 100, 200, *range(1, 30), 101, 102, 300, 301, 302, 303, -5, -100, -3]), rng.choice([None, 0, 1, 2, 3, 4]), rng.choice([None, "user", "assistant"]), some()) for _ in range(150)]
    data += data[:20] + [(1001, 0, "user", "no first conversation"), (1002, 0, "user", "x"), (1003, 0, "user", "y"), (1004, 0, "u", "z")]
    assert got(op.conversation_trie(table_of(spark, data).repartition(3))) == brute(data)


def test_hot_nodes_long_conversations_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_IDS", 3)
    monkeypatch.setattr(ordinals, "CHUNK", 5)
    data = [(c, t, "user", f"same {t}") for c in range(60) for t in range(3)]  # many end at one node
    data += [(7, t, "user", f"own {t}") for t in range(3, 200)] + [(c, 3, "user", "fork") for c in range(20, 40)] + [(107, t, "user", f"own {t}") for t in range(150)]
    found = got(op.conversation_trie(table_of(spark, data).repartition(4)))
    assert found == brute(data) and max(r[1] for r in found) == 200


def test_chains_within_chains(spark):
    # the smallest member changes at every depth, so each chain hangs on another chain
    data = [(c, t, "u", "x" * (t + 1)) for c in range(100, 140) for t in range(c - 99)] + [(500 - c, t, "u", "y" * (t + 1)) for c in range(40) for t in range(40 - c)]
    assert got(op.conversation_trie(table_of(spark, data))) == brute(data)
    assert got(op.conversation_trie(table_of(spark, data), group=1, shared=1)) == brute(data, 1, 1)


def test_empty_table(spark):
    assert op.conversation_trie(table_of(spark, [])).count() == 0
    assert op.conversation_trie(table_of(spark, [(None, 1, "user", "x")])).count() == 0
