"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandmill.shipping import ship_package

#: White space between words: ``[\x20\x09-\x0D]``, also what ``bytes.split()`` splits at.
SPACE = r"[\x20\x09-\x0D]+"
#: ``bytes.translate`` table that lower-cases A-Z only.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema,
    give_back: bool = True,
) -> DataFrame:
    """``mapInArrow`` with this package importable on the executors.

    Workers are used again by later tasks, so what a task has freed goes back to the system; jobs of
    many short passes do without.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            if give_back:
                _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that columns added beside it clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")


def text_column(batch: pa.RecordBatch) -> pa.Array:
    """The column ``text``, or that field of ``__row``."""
    at = batch.schema.get_field_index("__row")
    return batch.column(at).field("text") if at >= 0 else batch.column("text")


def texts_of(batch: pa.RecordBatch) -> Iterator[bytes]:
    """UTF-8 bytes of the texts, one after the other; null becomes empty."""
    return (t.as_py() or b"" for t in text_column(batch).cast(pa.binary()))


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a null id counts as the empty text (0)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def with_columns_after(schema, added: str) -> str:
    """DDL of a schema's columns without those that ``added`` names again, then ``added``."""
    from pyspark.sql import types as T

    new = T._parse_datatype_string(added)
    taken = {n.lower() for n in new.names}
    kept = [f for f in schema.fields if f.name.lower() not in taken]
    return T.StructType(kept + new.fields)
