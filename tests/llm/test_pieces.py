"""Encoding and decoding against the sentencepiece library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandmill.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(texts, library):
    loaded = pieces.load(MODEL)
    ids, sizes = pieces.Encoder(loaded)(texts)
    got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    want = [library.encode(t or "") for t in texts]
    assert got == want
    assert pieces.decode(loaded, ids, sizes) == [library.decode(w) for w in want]


def test_cases(library):
    same(
        ["", None, " ", "  ", "\n", " \n ", "a", "▁▁a", " " * 50 + "x", "aaaaaaaaaa", "<s>hi</s>",
         "<0x0A>", " ⁇ x", "\u0000", "汉字 😀", "x\ty\r\nz", "ﬁ", "é", "a" * 3000, "ab" * 30_000],
        library,
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), min_size=1, max_size=5))
def test_any_text(library, texts):
    same(texts, library)


def test_near_vocabulary(library):
    rng = random.Random(3)
    same(["".join(rng.choices("aehnt r  .\n▁", k=rng.randint(1, 400))) for _ in range(300)], library)


def test_any_ids(library):
    rng = random.Random(5)
    odd = [0, 1, 2, 3, 5, 130, 200, 198, 259, 28705, 400]
    ids = [[rng.choice(odd) for _ in range(rng.randint(0, 9))] for _ in range(3000)]
    flat = np.array([i for x in ids for i in x])
    got = pieces.decode(pieces.load(MODEL), flat, np.array([len(x) for x in ids]))
    assert got == [library.decode(x) for x in ids]


def test_frames(docs_of, library):
    rows = [(1, "hello world"), (2, None), (3, ""), (3, ""), (None, "x " * 40_000), (4, " é\n")]
    df = docs_of(rows).withColumn("ids", F.lit("clash"))
    out = pieces.encode(df, MODEL, with_text=True)
    assert out.count() == len(rows)
    for r in out.collect():
        assert r.ids == library.encode(r.text or "") and r.decoded == (r.text or "")
    back = pieces.decode_ids(out.drop("decoded"), MODEL)
    assert all(r.decoded == (r.text or "") for r in back.collect())
    assert pieces.encode(docs_of([]), MODEL).count() == 0


def test_bounded_memory_of_words(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    encoder = pieces.Encoder(pieces.load(MODEL))
    for n in range(5):
        text = " ".join(f"word{n}{i}" for i in range(30))
        assert encoder([text])[0].tolist() == library.encode(text)
