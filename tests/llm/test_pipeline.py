"""Every stage of the pipeline against brute force on its own input."""

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from demandmill.llm import language_id, mixing
from demandmill.llm.common import fold
from test_exact_dedup import brute as exact_groups
from test_mixing import brute_targets, words
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Input of the first stage and output of each, written and read again."""
    root = tmp_path_factory.mktemp("pipeline")
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def test_stages(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_dedup", "mixing", "sentencepiece",
    ]
    for df in tables[:-1]:
        assert df.columns == COLUMNS


def test_languages(spark, tables):
    before, after = tables[0], {r.doc_id for r in tables[1].collect()}
    model = language_id.train(before, fold("doc_id", 5) != 0)
    want = language_id.predict(before, model).where("accepted").collect()
    assert after == {r.doc_id for r in want}
    assert len(after) >= 0.99 * before.count()


def test_exact_copies(tables):
    rows = [(r.doc_id, r.text) for r in tables[1].collect()]
    want = {r[0] for r in exact_groups(rows) if r[3]}
    got = [r.doc_id for r in tables[2].collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_near_copies(tables):
    rows = [(r.doc_id, r.text) for r in tables[2].collect()]
    label = plain_components([plain_fingerprint(t) for _, t in rows])
    groups = {}
    for (doc_id, _), c in zip(rows, label):
        groups[c] = min(groups.get(c, doc_id), doc_id)
    got = [r.doc_id for r in tables[3].collect()]
    assert sorted(got) == sorted(groups.values())


def test_mixture(tables):
    before, after = tables[3].collect(), Counter(r.doc_id for r in tables[4].collect())
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in before:
        size = words(r.text)
        sizes[r.source] += size
        taken[r.source] += size * after[r.doc_id]
        largest[r.source] = max(largest[r.source], size)
    want = brute_targets(sizes)
    assert set(after) <= {r.doc_id for r in before} and max(after.values()) <= mixing.MAX_COPIES
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_tokens(tables):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in tables[4].collect()}
    out = tables[5].collect()
    assert len(out) == tables[4].count()
    for r in out:
        assert r.ids == library.encode(texts[r.doc_id])


def test_decoded_texts(tables):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = tables[5].collect()
    assert out
    for r in out:
        assert r.decoded == library.decode(r.ids)


def test_run_gives_the_same(spark, tables):
    got = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("ids").alias("ids"))
    want = tables[-1].groupBy("doc_id").agg(F.count("*").alias("n"), F.max("ids").alias("ids"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stages_take_nulls_repeats_and_empty_tables(spark, docs_of):
    rows = [
        (1, None), (2, ""), (3, "the of and that with from", "en", None), (None, "the of and that with from", "en", "s"),
        (4, "que los para con una", "es", "s"), (4, "que los para con una", "es", "s"), (5, "123", None, "t"),
        (6, "the of and to in " * 5000, "en", "t"), (11, "das und der nicht", "de", "t"), (12, "die und das", "de", "t"),
    ]
    for df in (docs_of(rows).cache(), docs_of([])):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, df, SF).collect()
    out = docs_of(rows)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
    assert out.count() > 0
