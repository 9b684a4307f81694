import json
import os
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from edge_rows import ROWS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textloom.llm import token_store as op

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return op.WordwiseEncoder(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [op.END_ID]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abzAZ é́̈ÉßHh'.,=!<>|09 \t\n漢😀ſKİ̸"), max_size=30), max_size=4))
def test_runs_encode_like_whole_texts(texts):
    encoder = op.WordwiseEncoder(PATH)
    ids, off = encoder(pa.array(texts, pa.string()), op.END_ID)
    for k, text in enumerate(texts):
        assert ids[off[k] : off[k + 1]].tolist() == ids_of(text)


def test_special_strings(encoder):
    texts = ["a <|endoftext|> b", "x<|STARTOFTEXT|>y", "I'm don'T <| endoftext |>"]
    ids, off = encoder(pa.array(texts), op.END_ID)
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [ids_of(t) for t in texts]


def test_edge_rows(edge):
    store = op.write_token_store(edge, PATH, batch_bytes=1000)
    got = store.digest().collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in order]
    start = 0
    for r, (_, text) in zip(got, order, strict=True):
        ids = ids_of(text)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_one_document_is_read_alone(docs_of):
    store = op.write_token_store(docs_of([(i, f"word{i} " * (i + 1)) for i in range(300)]), PATH)
    assert store.dictionary
    shard = op.Shard(f"{store.folder}/{store.manifest[0][1]}", store.dictionary)
    row = 3
    assert shard.ids(row).tolist() == ids_of(f"word{shard.index[row]['doc_id']} " * (int(shard.index[row]["doc_id"]) + 1))
    with pytest.raises(ValueError):
        op.Shard(f"{store.folder}/{store.manifest[0][1]}", b"another")


def test_a_fresh_process_reads_the_folder(docs_of):
    texts = {i: f"word{i} " * (i + 1) for i in range(300)}
    store = op.write_token_store(docs_of(list(texts.items())), PATH)
    assert store.dictionary
    code = """
import json, sys
from textloom.llm.token_store import TokenStore
store, out, at = TokenStore.open(sys.argv[1]), {}, 0
for k, (_, _, start) in enumerate(store.manifest):
    shard = store.shard(k)
    assert start == at
    for row in range(len(shard.index)):
        out[int(shard.index[row]["doc_id"])] = shard.ids(row).tolist()
    at += int(shard.index["n_ids"].sum())
print(json.dumps(out))
"""
    done = subprocess.run([sys.executable, "-c", code, store.folder], capture_output=True, text=True, timeout=100, check=True, env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)})
    assert {int(i): ids for i, ids in json.loads(done.stdout.splitlines()[-1]).items()} == {i: ids_of(t) for i, t in texts.items()}
    assert sorted(map(tuple, op.TokenStore.open(store.folder).digest().collect())) == sorted(map(tuple, store.digest().collect()))


def test_empty_table(nothing):
    assert op.write_token_store(nothing, PATH).digest().count() == 0
