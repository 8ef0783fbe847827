"""Token files against the tokenizers library and plain packing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from demandmill.llm import token_files as tf
from demandmill.session import shared_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def plain(rows, end=0):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library(text), end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def key(row):
    return row[0] is not None, row[0] or 0, row[1]


@pytest.fixture
def folder(spark, request):
    return f"{shared_dir(spark)}/{request.node.name}-{random.getrandbits(40)}"


@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, 2**b - 1), max_size=70))))
def test_packing_round_trip(case):
    bits, ids = case
    packed = tf.pack(np.array(ids, np.uint64), bits)
    assert len(packed) == -(-len(ids) // 8) * bits
    assert tf.unpack(packed, bits, len(ids)).tolist() == ids
    number = int.from_bytes(packed, "little")
    assert [number >> (bits * i) & (2**bits - 1) for i in range(len(ids))] == ids


def test_least_bits():
    assert [tf.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_text(texts):
    encoder = tf.load(PATH)
    assert [x.tolist() for x in encoder(texts)] == [library(t) for t in texts]


ODD = st.sampled_from(list(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0'sStTllvrem.,!0123abcéßЖж中あ가’—…​ ²½١") + ["<|endoftext|>", "  ", "'re"])


@given(st.lists(ODD, max_size=30).map("".join))
@settings(max_examples=1000, deadline=None)
def test_ids_of_odd_texts(text):
    assert [x.tolist() for x in tf.load(PATH)([text])] == [library(text)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_go_to_the_library(name):
    path = public_tokenizers.path(name)
    texts = ["Hello  world", "", "<|endoftext|> x", "naïve"]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in tf.Encoder(path)(texts)] == want


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 3)
    encoder = tf.Encoder(PATH)
    for text in ["one two three four", "five six seven", "one two three four"]:
        assert [x.tolist() for x in encoder([text])] == [library(text)]


def test_files_equal_the_library(spark, sf, folder):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = tf.token_table(docs, PATH, folder, shard_bytes=50_000)
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in found.collect()), key=key) == want
    index = spark.read.parquet(f"{folder}/index").orderBy("shard").collect()
    assert len(index) > 3 and index[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(index, index[1:]))


def test_random_access(spark, docs_of, folder):
    rows = [(i, f"word {i} " * (i % 40)) for i in range(300)]
    tf.write_tokens(docs_of(rows), PATH, folder, end_id=50256, shard_bytes=9_000, per_block=64)
    flat = [i for _, t in rows for i in [*library(t), 50256]]
    for start, count in [(0, 10), (63, 2), (1000, 5000), (len(flat) - 3, 10), (len(flat), 4)]:
        assert tf.tokens_at(spark, folder, start, count).tolist() == flat[start : start + count]
    found = {r.doc_id: r.ids for r in tf.read_tokens(spark, folder).collect()}
    assert found == {i: [*library(t), 50256] for i, t in rows}


def test_nulls_empty_long_and_shared_ids(spark, docs_of, folder):
    rows = [(None, "no id"), (3, None), (1, ""), (2, "long " * 60_000), (5, "b"), (5, "a"), (5, "a"), (4, "\u0000")]
    found = [tuple(r) for r in tf.token_table(docs_of(rows), PATH, folder, shard_bytes=2_000).collect()]
    alone = [r for r in found if r[0] != 5]
    assert sorted(alone, key=key) == [r for r in plain(rows) if r[0] != 5]
    shared = sorted((r for r in found if r[0] == 5), key=key)
    assert [r[1] for r in shared] == [r[1] for r in plain(rows) if r[0] == 5]
    assert sorted(r[3] for r in shared) == sorted(r[3] for r in plain(rows) if r[0] == 5)


def test_hot_id_is_split_over_files(spark, docs_of, folder):
    rows = [(9, "the same text in every row")] * 400 + [(i, "other") for i in range(100, 200)]
    found = tf.token_table(docs_of(rows), PATH, folder, shard_bytes=4_000).collect()
    assert sorted((tuple(r) for r in found), key=key) == plain(rows)
    index = spark.read.parquet(f"{folder}/index").collect()
    assert max(r.n_docs for r in index) < 150


def test_text_ids_and_clashing_columns(spark, folder):
    df = spark.createDataFrame([("b", "x", 1), ("a", "y", 2)], "doc_id string, text string, IDS long")
    found = {r.doc_id: (r.start, r.n_tokens) for r in tf.token_table(df, PATH, folder).collect()}
    assert found == {"a": (0, 2), "b": (2, 2)}


def test_empty_table(spark, docs_of, folder):
    assert tf.token_table(docs_of([]), PATH, folder).collect() == []
    assert tf.tokens_at(spark, folder, 0, 5).tolist() == []


def test_other_bytes_are_refused():
    with pytest.raises(ValueError, match="packed"):
        tf.Shard(bytes(200))
