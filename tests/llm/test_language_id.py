"""Language ID: held-out accuracy, rejection and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from demandmill.llm import language_id
from demandmill.llm.common import fold


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = fold("doc_id", 5) == 0
    model = language_id.train(docs, ~held)
    out = language_id.predict(docs, model).where(held).collect()
    right = sum(r.lang == r.lang_pred for r in out)
    assert right / len(out) > 0.97
    assert sum(r.accepted for r in out) / len(out) > 0.99
    assert all(0 <= r.score <= 1 for r in out)


def test_cases(documents, docs_of):
    model = language_id.train(documents, F.lit(True))
    rows = [(1, None), (2, ""), (3, "123 !?"), (5, "½ ② Ⅷ x²"[:6]), (6, "①②"), (4, "the " * 50_000), (4, "the"), (None, "de la les")]
    df = docs_of(rows).withColumn("score", F.lit("clash"))
    got = {(r.doc_id, (r.text or "")[:8]): r for r in language_id.predict(df, model).collect()}
    for key in [(1, ""), (2, ""), (3, "123 !?"), (5, "½ ② Ⅷ "), (6, "①②")]:
        assert (got[key].lang_pred, got[key].score, got[key].accepted) == ("und", 0.0, False)
    assert got[(None, "de la le")].lang_pred == "fr"
    assert language_id.predict(docs_of([]), model).count() == 0
    # a table of one short word
    assert language_id.predict(docs_of([(1, "a")], 1), model).first().lang_pred != "und"


def test_nothing_to_learn_from(docs_of):
    df = docs_of([(1, "text"), (2, None)])
    model = language_id.train(df, F.lit(True))
    assert model is None
    assert {(r.lang_pred, r.accepted) for r in language_id.predict(df, model).collect()} == {("und", False)}


def test_words_decide_not_labels(documents):
    """lang, source and doc_id are no inputs of a prediction."""
    model = language_id.train(documents, F.lit(True))
    first = language_id.predict(documents, model).select("doc_id", "lang_pred", "score")
    other = documents.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string")})
    again = language_id.predict(other, model).select("doc_id", "lang_pred", "score")
    assert sorted(first.collect()) == sorted(again.collect())


def test_reruns_agree(documents):
    a = language_id.train(documents, F.lit(True))
    b = language_id.train(documents.repartition(5), F.lit(True))
    assert (a.embedding == b.embedding).all() and a.threshold == b.threshold


def test_the_sample_is_bounded_and_the_same_for_any_dealing(docs_of):
    """An id that many rows share, and repeated rows, neither fill nor empty the sample."""
    rows = [(1, f"the word number {'x' * (i % 40)} {i}", "en") for i in range(400)]
    rows += [(2, "le mot", "fr")] * 300 + [(i, f"le mot {'y' * (i % 30)}", "fr") for i in range(100)]
    one = language_id.train(docs_of(rows), F.lit(True), per_class=50)
    two = language_id.train(docs_of(rows, 11), F.lit(True), per_class=50)
    assert (one.embedding == two.embedding).all() and one.languages == ["en", "fr"]
    out = language_id.predict(docs_of([(1, "the word number"), (2, "le mot")]), one).collect()
    assert {r.doc_id: r.lang_pred for r in out} == {1: "en", 2: "fr"}


def test_prediction_equals_a_plain_sum(documents):
    """Every n-gram of every word looked up by itself."""
    model = language_id.train(documents, F.lit(True))
    table = model.embedding @ model.output
    for r in language_id.predict(documents.limit(20), model).collect():
        words = language_id.words_of(r.text or "")
        if not words:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        rows = [table[b] for w in words for b in language_id.word_buckets([w])[0]]
        logits = np.mean(rows, axis=0) + model.bias
        chance = language_id.softmax(logits[None] / model.temperature)[0]
        assert model.languages[chance.argmax()] == r.lang_pred and abs(chance.max() - r.score) < 1e-4
