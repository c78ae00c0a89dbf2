"""Tokenization against the public library, on its models and on hand-made ones."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from visitlens.llm import queries
from visitlens.llm.sentencepieces import PieceModel, decode_pieces, encode_texts

PATH = f"{queries.TOKENIZERS}/{queries.PIECES}"


def message(*fields) -> bytes:
    """A protocol-buffer message of (number, value) pairs."""
    out = bytearray()

    def varint(n):
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)

    for number, value in fields:
        kind = {int: 0, bytes: 2, float: 5}[type(value)]
        varint(number << 3 | kind)
        if kind == 0:
            varint(value)
        elif kind == 2:
            varint(len(value))
            out += value
        else:
            out += struct.pack("<f", value)
    return bytes(out)


def unigram(dummy=1, collapse=0) -> bytes:
    scores = {"▁": -3.0, "a": -4.0, "b": -4.5, "c": -5.0, "ab": -5.5, "▁ab": -6.0, "bc": -5.2, "abc": -7.0, "▁a": -5.0, "ca": -6.5}
    pieces = [(1, message((1, b"<unk>"), (2, 0.0), (3, 2))), (1, message((1, b"<s>"), (2, 0.0), (3, 3)))]
    pieces += [(1, message((1, p.encode()), (2, s))) for p, s in scores.items()]
    return message(*pieces, (2, message((3, 1))), (3, message((1, b"identity"), (3, dummy), (4, collapse), (5, 1))))


@pytest.fixture(scope="module")
def pair():
    raw = open(PATH, "rb").read()
    return PieceModel(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)


def agree(model, library, texts):
    ids = model.encode(pa.array(texts, pa.string()))
    assert [x or [] for x in ids.to_pylist()] == library.encode([t or "" for t in texts])
    assert [x is None for x in ids.to_pylist()] == [t is None for t in texts]
    return model.decode(ids).to_pylist()


def test_bpe_equals_the_library(pair):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzABC   ,.\n\t0189éüßñ日本😀{}()'\""
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(300)]
    texts += ["", None, " ", "  ", "\n", "x" * 3000, " " * 70 + "def f(x):\n\treturn x", "日本語のテキスト", "𝄞", "\u0000\u0001"]
    assert agree(*pair, texts) == texts


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60).filter(lambda t: "▁" not in t and "\ufffd" not in t))
def test_any_text_round_trips(pair, text):
    assert agree(*pair, [text]) == [text]


@pytest.mark.parametrize("dummy,collapse", [(1, 0), (0, 0), (1, 1)])
def test_unigram_equals_the_library(dummy, collapse):
    raw = unigram(dummy, collapse)
    model, library = PieceModel(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    rng = random.Random(2)
    texts = ["".join(rng.choice("aabbcc  xy") for _ in range(rng.randint(0, 25))) for _ in range(300)]
    ids = model.encode(pa.array(texts)).to_pylist()
    score = lambda path: sum(model.scores[k] for k in path if k != model.unknown)
    for mine, theirs in zip(ids, library.encode(texts)):
        # paths of equal weight may differ
        assert mine == theirs or (abs(score(mine) - score(theirs)) < 1e-4 and mine.count(0) == theirs.count(0))


def test_meta_space_is_a_space(pair):
    assert agree(*pair, ["a▁b"]) == ["a b"]


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        PieceModel(message((1, message((1, b"<unk>"), (3, 2))), (3, message((2, b"map")))))
    with pytest.raises(ValueError):
        PieceModel(message((1, message((1, b"<unk>"), (3, 2))), (2, message((3, 3)))))


def test_segments_are_forgotten_without_effect(pair, monkeypatch):
    from visitlens.llm import sentencepieces

    monkeypatch.setattr(sentencepieces, "MEMORY", 3)
    model = PieceModel(open(PATH, "rb").read())
    agree(model, pair[1], ["the quick brown fox jumps over the lazy dog again and again"] * 2)


def test_encode_and_decode_tables(documents):
    texts = {1: "Hello  wörld\n", 2: None, 3: "", 4: "x" * 40_000, 5: "a▁b"}
    df = documents(texts, order=[*texts.items(), (1, texts[1]), (None, "t")])
    out = encode_texts(df, PATH)
    rows = out.collect()
    assert len(rows) == 7
    assert {r.doc_id: r.round_trip for r in rows} == {1: True, 2: None, 3: True, 4: True, 5: False, None: True}
    assert all(r.n_pieces == (None if r.pieces is None else len(r.pieces)) for r in rows)
    back = {r.doc_id: r.text for r in decode_pieces(out, PATH).collect()}
    assert back == texts | {5: "a b", None: "t"}
    assert encode_texts(df.limit(0), PATH).collect() == []
    assert np.all([r.pieces == [] for r in rows if r.doc_id == 3])
