"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandmill.llm import (
    chat,
    exact_dedup,
    fingerprints,
    language_id,
    licenses,
    lm_score,
    mixing,
    pieces,
    prefix_trie,
    secrets,
    simhash,
    token_files,
    whitening,
)
from demandmill.llm.common import fold, read
from demandmill.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

#: Path of the tokenizer model; executors open it at the same place.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


#: Conversation -7: control strings inside texts.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], rows.schema
    )
    return chat.read_back(chat.format_chats(rows.unionByName(extra)))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = lm_score.score(docs, fold("doc_id", 10) != 0)
    return scored.withColumn("held_out", ~F.col("learn")).drop("learn")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = language_id.train(docs, ~held_out)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language_id.predict(rows, model).drop("text")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pieces.encode(docs, PIECE_MODEL, with_text=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: the best match (highest score, then name, then place) and all matches."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs).drop("text")
    best = F.array_max(
        F.transform(
            "licenses",
            lambda m: F.struct(m["dice"].alias("dice"), (-m["first_word"]).alias("at"), m["template"].alias("template")),
        )
    )
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_matches"),
        best["template"].alias("license"),
        best["dice"].alias("dice"),
        F.concat_ws(
            ",",
            F.transform(
                "licenses",
                lambda m: F.concat_ws(
                    ":", m["template"], m["first_word"].cast("string"), m["end_word"].cast("string")
                ),
            ),
        ).alias("matches"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select(
        "__row.doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan_secrets(docs)
    base = F.filter("spans", lambda s: s["layer"] == 0)

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.withColumn("base", base).select(
        "doc_id", *[count(kind) for kind, *_ in secrets.KINDS],
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"), "complete",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.sequences(read(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(own))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it does not fit a long."""
    rows = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    return token_files.token_table(read(spark, sf_dir, "documents"), BYTE_TOKENIZER, path)


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_chat": op2_chat,
    "op3_fingerprints": op3_fingerprints,
    "op4_lm_score": op4_lm_score,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_language_id": op6_language_id,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_license_scan": op8_license_scan,
    "op9_mixing": op9_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whitening": op12_whitening,
    "op13_token_files": op13_token_files,
}

ORACLES: dict[str, str] = {
    # Escapes: one per backslash, closing marker, and place where three # begin (roles need none).
    "op2_chat": r"""
WITH src AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
t AS (
    SELECT *, row_number() OVER w AS nth, lag(role) OVER w AS before,
           length(text) - length(replace(text, '\', ''))
           + (length(text) - length(replace(text, '</turn>', ''))) // 7
           + coalesce(list_sum(list_transform(regexp_extract_all(text, '###+'), lambda x: length(x) - 2)), 0)
             AS escapes
    FROM src WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(4 + length(role) + 2 + length(text) + escapes + 8) AS BIGINT) AS formatted_chars,
       bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                     WHEN before IN ('system', 'assistant') THEN role = 'user'
                     WHEN before = 'user' THEN role = 'assistant'
                     ELSE false END) AS in_order
FROM t GROUP BY conv_id
""",
    "op5_exact_dedup": r"""
WITH t AS (
    SELECT doc_id, coalesce(length(text), 0) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM t
""",
    # crc32 bit by bit; a node is the text of its turns' ids.
    "op11_prefix_trie": r"""
WITH src AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
coded AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
           dense_rank() OVER (ORDER BY role, text) AS id,
           len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM src
),
convs AS (
    SELECT conv_id, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(
            range(1, length(conv_id::VARCHAR) + 1),
            lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
                          WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM src)
),
built AS (
    SELECT conv_id, nth, id, words FROM coded JOIN convs USING (conv_id) WHERE nth > h
    UNION ALL
    SELECT v.conv_id, c.nth, c.id, c.words
    FROM convs v JOIN coded c ON c.conv_id = v.conv_id - v.conv_id % 20 AND c.nth <= v.h
),
prefixes AS (
    SELECT conv_id, row_number() OVER w AS depth, words,
           string_agg(id::VARCHAR, ',') OVER w AS node
    FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY nth)
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
),
paths AS (
    SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS last
    FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
),
nodes AS (
    SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(words) AS saving,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), ''))
             AS ends_sha256
    FROM paths GROUP BY node, depth
),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
subtrees AS (
    SELECT p.node, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves, sum(n.saving) AS saved_tokens
    FROM nodes n LEFT JOIN children c ON c.node = n.node
    JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
    GROUP BY p.node
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(c.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes up ON up.node = n.parent
LEFT JOIN children c ON c.node = n.node JOIN subtrees s ON s.node = n.node
""",
}
