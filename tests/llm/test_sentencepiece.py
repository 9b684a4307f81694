import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from edge_rows import ROWS
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import sentencepiece_viterbi as op

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = op.PieceModel(op.read_pieces(PATH))


def brute(text, pieces, unknown):
    """Best score sum over all segmentations of ' ' + text; pieces: text to score."""
    data = " " + text
    best = [0.0] + [-np.inf] * len(data)
    for i in range(len(data)):
        for j in range(i + 1, min(len(data), i + 16) + 1):
            if (s := pieces.get(data[i:j])) is not None:
                best[j] = max(best[j], best[i] + s)
        if data[i] not in pieces:
            best[i + 1] = max(best[i + 1], best[i] + unknown)
    return best[-1]


def test_pieces_are_read_like_the_library_does():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    own = op.read_pieces(PATH)
    assert len(own) == library.vocab_size()
    assert all(own[i][0].decode() == library.id_to_piece(i) and own[i][1] == pytest.approx(library.get_score(i)) for i in range(0, len(own), 37))


def test_scores_are_the_best():
    pieces = {p.replace(op.META, b" ").decode(): s for p, s, kind in op.read_pieces(PATH) if kind == 1}
    texts = ["the quick brown fox", "Überraschung naïve", "aaa bbb  ccc", "x", "tionnt blehua ererha"]
    ids, off = MODEL.encode(pa.array(texts))
    for k, text in enumerate(texts):
        own = ids[off[k] : off[k + 1]]
        assert MODEL.scores[own].sum() == pytest.approx(brute(text, pieces, MODEL.unknown))


def test_scores_equal_the_library_s_unigram_search():
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = "ononthatble heredand Schifffahrt transformation uncharacteristically encodings".split()
    ids, off = MODEL.encode(pa.array(words))
    for k, word in enumerate(words):
        assert MODEL.scores[ids[off[k] : off[k + 1]]].sum() == MODEL.scores[library.encode(word)].sum()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_round_trip(texts):
    ids, off = MODEL.encode(pa.array(texts, pa.string()))
    assert MODEL.decode(ids, off) == [t.encode() for t in texts]


def test_edge_rows(edge, nothing):
    got = op.sentencepiece_digest(edge, MODEL, batch_bytes=500, with_ids=True).collect()
    assert len(got) == len(ROWS) and all(r.round_trip for r in got)
    assert all(len(r.piece_ids) == r.n_pieces for r in got)
    assert {r.n_pieces for r in got if r.n_bytes == 0} == {0}
    assert op.sentencepiece_digest(nothing, MODEL).count() == 0


def test_encode_and_decode_columns(edge):
    back = op.sentencepiece_decode(op.sentencepiece_encode(edge, MODEL), MODEL)
    assert back.columns == [*[c for c in edge.columns if c != "piece_ids"], "piece_ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in back.collect())


def test_a_long_unit(docs_of):
    text = "qzx" * 3000
    assert op.sentencepiece_digest(docs_of([(1, text)]), MODEL).first().round_trip
