"""Registered queries against their SQL, and the shape that each must return."""

import pytest

import __spark_entry__ as entry
from compare import differences, open_tables
from demandmill.llm import queries
from demandmill.llm.whitening import usable

COLUMNS = {
    "op1_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op2_chat": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op3_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op4_lm_score": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op6_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7_sentencepiece": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op8_license_scan": "doc_id bigint, license string, dice double",
    "op9_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op11_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op12_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op13_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
}
#: Rows that a query gives for its table, if not one per document.
ROWS = {
    "op2_chat": lambda spark, sf: spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count() + 1,
    "op11_prefix_trie": None,  # compared with SQL
    "op12_whitening": lambda spark, sf: 8 * usable(spark.read.parquet(f"{sf}/embeddings.parquet")).count(),
}


@pytest.mark.parametrize("name", list(queries.ORACLES))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_sql(spark, name, size):
    folder = f"/root/testdata/{size}"
    assert differences(queries.QUERIES[name](spark, folder), open_tables(folder), queries.ORACLES[name]) == []


def test_every_operator_is_registered():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    kinds = dict(df.dtypes)
    for column in COLUMNS[name].split(", "):
        column, kind = column.split()
        assert kinds[column] == kind
    count = ROWS.get(name, lambda spark, sf: spark.read.parquet(f"{sf}/documents.parquet").count())
    if count:
        assert df.count() == count(spark, sf)
