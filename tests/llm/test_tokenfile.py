import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marlstone.llm import tokenfile as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return tf.Encoder(PATH, 4)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_packing_round_trip(bits, ids):
    ids = np.array([i % 2**bits for i in ids], dtype="<u4")
    packed = tf.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert tf.unpack(packed, bits, len(ids)).tolist() == ids.tolist()


@pytest.mark.parametrize("bits", [3, 16, 17])
def test_files_give_any_span(bits, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK", 64)
    r = np.random.default_rng(1)
    docs = [(i if i % 5 else None, r.integers(0, 2**bits, n).astype("<u4")) for i, n in enumerate([0, 1, 63, 64, 65, 500, 0])]
    f = tf.TokenFile(tf.build_file(docs, bits, 3, 1, 10) + b"\n")
    ids = np.concatenate([d for _, d in docs])
    for a, b in [(0, 0), (0, 1), (63, 65), (100, 400), (0, len(ids)), (len(ids) - 1, len(ids))]:
        assert f.ids(a, b).tolist() == ids[a:b].tolist()
    assert [f.document(i).tolist() for i in range(7)] == [d.tolist() for _, d in docs] and f.doc_ids == [d for d, _ in docs]
    with pytest.raises(ValueError):
        tf.TokenFile(tf.build_file(docs, bits, 3, 1, 10))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t 　\x1cabé'sdt12.,;<|>endoftx漢")), max_size=40))
def test_pieces_encode_like_whole_texts(tokenizer, encoder, text):
    assert np.frombuffer(next(encoder.encode([text])), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("\n\n\n \x01ab.1½")), max_size=20), max_size=8))
def test_lines_encode_like_whole_texts(tokenizer, encoder, texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_with_other_rules_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    other, texts = tf.Encoder(path, 4), ["One two.\nThree four", "", "a  b\n\nc"]
    plain = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in other.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_equals_brute_force(docs, spark, tokenizer):
    got = {r.doc_id: r for r in tf.round_trip(docs, PATH).collect()}
    at = 0
    for r in docs.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)


def test_odd_rows(odd, empty, monkeypatch):
    rows = sorted(tf.round_trip(odd, PATH).collect(), key=lambda r: r.start)
    assert len(rows) == 12 and rows[0].doc_id is None
    assert [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [1, 1]
    assert tf.round_trip(empty, PATH).collect() == []


def test_ids_that_need_more_bits_are_errors():
    with pytest.raises(ValueError):
        tf.pack(np.array([5, 8], dtype="<u4"), 3)
    with pytest.raises(ValueError):
        tf.Encoder(PATH, 1)
    assert tf.vocabulary_of(PATH) == max(Tokenizer.from_file(PATH).get_vocab().values()) + 1
