"""Training-data pipeline over ``documents``: each stage works on what the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from demandmill.llm import exact_dedup, language_id, mixing, pieces, simhash
from demandmill.llm.common import fold, whole_row
from demandmill.llm.queries import PIECE_MODEL
from demandmill.session import shared_dir


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; trained on labelled ones outside the held-out fold."""
    model = language_id.train(docs, fold("doc_id", 5) != 0)
    rows = language_id.predict(docs.select(whole_row(docs)), model)
    return rows.where("accepted").select("__row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, and the text they decode to."""
    rows = docs.select("doc_id", "source", "lang", "text")
    return pieces.encode(rows, PIECE_MODEL, with_text=True).drop("text")


STAGES = [
    ("language_id", languages),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("mixing", mixture),
    ("sentencepiece", tokens),
]

#: Hash-ordered sampling, trained scores and fingerprints have no SQL form; tests compare each stage
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what each keeps is written as Parquet and read again."""
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
