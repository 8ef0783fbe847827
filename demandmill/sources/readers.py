"""Readers. Every one scans all matching files in a single DataFrame."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandmill.functions.dates import month_number
from demandmill.functions.rules import col
from demandmill.functions.text import without_nul
from demandmill.sources.layouts import Layout

PATH = "Source_File"
#: Headers read side by side.
READERS = 16
#: Column orders of one load among which a row's cells are chosen without a join.
MOST_ORDERS = 8


def _csv(spark: SparkSession):
    # Quotes inside a quoted cell are doubled in these files.
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", False)
    )


def file_path() -> Column:
    """Decoded path of the row's file."""
    path = F.col("_metadata.file_path")
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def file_time() -> Column:
    """Modification time of the row's file, in microseconds."""
    return F.unix_micros("_metadata.file_modification_time")


def headers(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, list[str]]]:
    """Path and column names of every file that has a first line, by path.

    Only the first line of a file is read, of many files side by side. Files are those of one load.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", file_path().alias(PATH)).collect()

    def names(file) -> tuple[str, list[str]]:
        line = first_line(spark, file.path) or ""
        cells = next(csv.reader([line.lstrip("\ufeff").removeprefix("ï»¿")]), [])
        return file[PATH], [n.strip() for n in cells]

    with ThreadPoolExecutor(READERS) as pool:
        return sorted(x for x in pool.map(names, files) if x[1])


def first_line(spark: SparkSession, path: str) -> str | None:
    """A file's first line, unpacked if its ending names a codec; what follows stays unread."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def _by_position(spark: SparkSession, paths: str | list[str], width: int) -> DataFrame:
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    return _csv(spark).schema(schema).csv(paths)


def read_report(
    spark: SparkSession, paths: str | list[str], layout: Layout, **added: Column
) -> DataFrame:
    """Report CSVs: columns by position, all text, plus the file path and columns ``added``.

    Positions mean the same only under one header: files whose headers differ (but for case), or have
    not as many columns as the layout, are an error.
    """
    kinds = {tuple(n.lower() for n in names): path for path, names in headers(spark, paths)}
    if len(kinds) > 1:
        raise ValueError(f"report files have different headers: {sorted(kinds.values())}")
    if kinds and len(next(iter(kinds))) != len(layout.columns):
        raise ValueError(f"{len(layout.columns)} columns expected, found {len(next(iter(kinds)))}")
    raw = _csv(spark).schema(layout.raw_schema()).csv(paths)
    return raw.select("*", file_path().alias(PATH), *[c.alias(n) for n, c in added.items()])


def read_weekly(spark: SparkSession, paths: str | list[str], **added: Column) -> DataFrame:
    """Weekly planning CSVs: all columns, each file's by the names in its own header, all text.

    Files may order their columns differently; they must have the same ones, else it is an error. All
    files are one scan: where orders differ, a row's cells are picked by its file's places; of a few
    orders directly from the scan, so that no row is built twice. Columns ``added`` come last.
    """
    found = [(path, weekly_names(names)) for path, names in headers(spark, paths)]
    if not found:
        raise ValueError("no weekly file with a header")
    first, names = found[0]
    for path, other in found:
        if set(other) != set(names) or len(set(other)) != len(other):
            odd = sorted(set(other) ^ set(names)) or "repeated names"
            raise ValueError(f"columns of {path} do not match {first}: {odd}")
    rows = _by_position(spark, paths, len(names))
    more = [file_path().alias(PATH), *[c.alias(n) for n, c in added.items()]]
    if all(other == names for _, other in found):
        cells = [without_nul(F.col(f"c{i}")).alias(n) for i, n in enumerate(names)]
        return rows.select(*cells, *more)
    orders: dict[tuple, list[str]] = {}
    for path, other in found:
        orders.setdefault(tuple(other), []).append(path)
    if len(orders) <= MOST_ORDERS:
        (last, _), *others = sorted(orders.items(), key=lambda x: len(x[1]))[::-1]

        def cell(name: str) -> Column:
            c = F.col(f"c{last.index(name)}")
            for order, files in others:
                c = F.when(file_path().isin(files), F.col(f"c{order.index(name)}")).otherwise(c)
            return without_nul(c).alias(name)

        known = rows.where(file_path().isin([path for path, _ in found]))
        return known.select(*[cell(n) for n in names], *more)
    # A row per file of the load. Spark knows no size of made rows, and packed files look smaller than
    # their rows are: without the hint it sends the files' rows about, or broadcasts them.
    places = spark.createDataFrame(
        [(path, [other.index(n) + 1 for n in names]) for path, other in found],
        f"{PATH} string, __places array<int>",
    )
    cells = F.array(*[F.col(f"c{i}") for i in range(len(names))]).alias("__cells")
    placed = rows.select(cells, *more).join(F.broadcast(places), PATH)
    return placed.select(
        *[
            without_nul(F.element_at("__cells", F.get("__places", F.lit(i)))).alias(n)
            for i, n in enumerate(names)
        ],
        PATH, *added,
    )


def weekly_names(header: list[str]) -> list[str]:
    """Header with the item's title named like in other files.

    The title is the third column, unless one has that name already.
    """
    if "Product_Title" in header:
        return header
    return [*header[:2], "Product_Title", *header[3:]]


def read_typed_csv(
    spark: SparkSession, paths: str | list[str], schema: T.StructType,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """CSV or exported sheet with a declared schema (nothing is inferred)."""
    return _csv(spark).option("dateFormat", date_format).schema(schema).csv(paths)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Saved table."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def base_name(path: Column | str) -> Column:
    """File name without its folders."""
    return F.substring_index(col(path), "/", -1)


def date_in_name(path: Column | str) -> Column:
    """Date of a weekly file: ``MM_DD_YYYY`` right before a four-character ending like ``.csv``.

    A packed file's further ending ``.gz`` is not looked at.
    """
    name = F.regexp_replace(base_name(path), "[.]csv[.]gz$", ".csv")
    text = F.substr(name, F.length(name) - 13, F.lit(10))
    return F.try_to_date(F.when(F.length(name) >= 14, text), "MM_dd_yyyy")


def month_in_name(path: Column | str) -> Column:
    """Month name of a monthly file: what stands between ``UPC_`` and the next ``_``; NULL if absent.

    The mark counts where it comes first; only letters make a month name.
    """
    after = F.split_part(base_name(path), F.lit("UPC_"), F.lit(2))
    month = F.when(F.contains(after, F.lit("_")), F.substring_index(after, "_", 1))
    return F.when(month.rlike("^[A-Za-z]+$"), month)


def year_in_name(path: Column | str) -> Column:
    """Year of a monthly file: the first four digits in a row of its name; NULL if there are none."""
    return F.regexp_substr(base_name(path), F.lit("[0-9]{4}"))


def month_columns(path: Column | str) -> dict[str, Column]:
    """Date, Month, Month_Num and Year of a monthly file."""
    month, year = month_in_name(path), year_in_name(path)
    number = month_number(month)
    return {
        "Date": F.try_to_date(
            F.concat_ws("-", year, number.cast("string"), F.lit("1")), "yyyy-M-d"
        ),
        "Month": month,
        "Month_Num": number,
        "Year": year,
    }


def day_columns(date: Column | str) -> dict[str, Column]:
    """Date, Month, Month_Num, Day and Year of a weekly file."""
    d = col(date)
    return {
        "Date": d,
        "Month": F.date_format(d, "MMMM"),
        "Month_Num": F.month(d),
        "Day": F.dayofmonth(d),
        "Year": F.year(d),
    }
