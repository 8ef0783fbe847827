"""Writers and publication.

A partitioned table is a Parquet directory; loading a version again replaces just its partition, so a
repeated or restarted load gives the same table, and history is not read to add to it.

Outputs that belong together are published at once: each run writes a folder of its own, and one small
pointer file, replaced in one step at the end, names the folders that count. Readers follow it. A run
that breaks leaves the pointer as it was, so readers see the old version whole, and a table is never
written where it is being read.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandmill.functions.rules import col
from demandmill.sources.readers import first_line, read_table

POINTER = "current.json"
ROW_DIGEST = "Row_Digest"


def write_csv(df: DataFrame, path: str, date_format: str = "yyyy-MM-dd") -> None:
    """CSV export with a header and without row names; blanks at the ends of a cell are kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("dateFormat", date_format)
        .csv(path)
    )


def write_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the partitions present in ``df``, leave the others alone.

    The rebalance hint gathers each partition's rows into few files, and splits a partition that is
    too large for one task.
    """
    write_dealt(df.hint("rebalance", *keys), path, keys)


def write_dealt(df: DataFrame, path: str, keys: list[str]) -> None:
    """``write_partitions`` of rows that lie as they should, few partitions to a task: none travels."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def hadoop(spark: SparkSession, path: str):
    """The path's file system, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = hadoop(spark, path)
    return system.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder or file, if it is there."""
    system, at = hadoop(spark, path)
    system.delete(at, True)


def partitions(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the partition folders at ``path``; none if nothing was written."""
    system, at = hadoop(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
    return [n.removeprefix(f"{key}=") for n in names if n.startswith(f"{key}=")]


def append_unique(all_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """History plus new rows, each distinct row once."""
    return all_rows.unionByName(new_rows).distinct()


def append_new(
    spark: SparkSession, path: str, new_rows: DataFrame, keys: list[str]
) -> None:
    """``append_unique`` on a stored table partitioned by ``keys``: writes only rows it does not hold.

    A stored row carries a digest of its values. The new rows are compared, by digest alone, with the
    partitions that they themselves fall in; no other partition is read, and nothing is written again.
    """
    values = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(new_rows.columns)]), {"ignoreNullFields": "false"})
    rows = new_rows.withColumn(ROW_DIGEST, F.sha2(values, 256)).dropDuplicates([ROW_DIGEST])
    if exists(spark, path):
        touched = new_rows.select(*keys).distinct().collect()
        # One condition per partition of the load; a load has few.
        here = F.lit(False)
        for row in touched:
            same = F.lit(True)
            for k in keys:
                same = same & F.col(f"`{k}`").eqNullSafe(F.lit(row[k]))
            here = here | same
        schema = rows.schema
        stored = spark.read.schema(schema).parquet(path).where(here).select(ROW_DIGEST)
        rows = rows.join(stored, ROW_DIGEST, "left_anti")
    rows.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).parquet(path)


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of ``append_new``."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


# ---- pointer ------------------------------------------------------------------------------------


def read_pointer(spark: SparkSession, root: str) -> dict:
    """What the pointer names; nothing before the first publication."""
    path = f"{root}/{POINTER}"
    return json.loads(first_line(spark, path)) if exists(spark, path) else {}


def switch_pointer(spark: SparkSession, root: str, named: dict) -> None:
    """Replace the pointer in one step."""
    jvm = spark._jvm.org.apache.hadoop.fs
    system, target = hadoop(spark, f"{root}/{POINTER}")
    target = system.makeQualified(target)
    fresh = jvm.Path(target.getParent(), f".{POINTER}-{uuid.uuid4().hex}")
    out = system.create(fresh)
    out.write(bytearray(json.dumps(named).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    options[0] = jvm.Options.Rename.OVERWRITE
    jvm.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fresh, target, options
    )


def new_run() -> str:
    """Name of a folder for one run."""
    return f"run-{uuid.uuid4().hex}"


def drop_unnamed(spark: SparkSession, root: str) -> None:
    """Remove the folders of runs that the pointer does not name. No run may be under way."""
    named = json.dumps(read_pointer(spark, root))
    system, at = hadoop(spark, root)
    for status in system.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("run-") and name not in named:
            system.delete(status.getPath(), True)


def rewrite(
    spark: SparkSession, root: str, change: Callable[[DataFrame | None], DataFrame]
) -> None:
    """Read-modify-write: the current rows (None at first), changed, are written beside them, then count."""
    named = read_pointer(spark, root)
    old = read_current(spark, root) if named else None
    run = new_run()
    change(old).write.parquet(f"{root}/{run}")
    switch_pointer(spark, root, {"rows": run, "before": named.get("rows")})


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    return read_table(spark, f"{root}/{read_pointer(spark, root)['rows']}", schema)


def export_name(version: Column | str) -> Column:
    """Month-stamped export name, ``06-Reworked Month End Raw Data - June 2020.csv``."""
    d = col(version)
    return F.concat(
        F.lpad(F.month(d).cast("string"), 2, "0"),
        F.lit("-Reworked Month End Raw Data - "),
        F.date_format(d, "MMMM yyyy"),
        F.lit(".csv"),
    )


def month_key(version: dt.date) -> str:
    return f"{version:%Y-%m}"


def month_before(version: dt.date) -> dt.date:
    """A day of the month before; in January that is December of the year before."""
    return version.replace(day=1) - dt.timedelta(days=1)


def publish_month_end(
    deltas: DataFrame, rework: Callable[[DataFrame], DataFrame], root: str, version: dt.date
) -> None:
    """Write the five month-end outputs of one version, then make them count together.

    ``rework`` makes the current table from the written deltas, so these are computed once. The exports
    (current, current without the combined column, previous month) are read from written months. The
    pointer names a folder per month for deltas and current tables, so other months stay where they are.
    """
    spark = deltas.sparkSession
    named, run, key = read_pointer(spark, root), new_run(), month_key(version)
    deltas.write.parquet(f"{root}/{run}/deltas")
    rework(spark.read.parquet(f"{root}/{run}/deltas")).write.parquet(f"{root}/{run}/monthly")
    written = spark.read.parquet(f"{root}/{run}/monthly")
    write_csv(written, f"{root}/{run}/current_csv", "MM/dd/yyyy")
    write_csv(written.drop("Actl_TP_Fcst_Delta"), f"{root}/{run}/last_month_csv", "MM/dd/yyyy")
    months = named.get("monthly", {}) | {key: f"{run}/monthly"}
    before = months.get(month_key(month_before(version)))
    previous = spark.read.parquet(f"{root}/{before}") if before else written.limit(0)
    write_csv(previous, f"{root}/{run}/previous_month_csv", "MM/dd/yyyy")
    exports = {n: f"{run}/{n}" for n in ("current_csv", "last_month_csv", "previous_month_csv")}
    switch_pointer(
        spark, root,
        {"monthly": months, "deltas": named.get("deltas", {}) | {key: f"{run}/deltas"}, **exports},
    )


def published_path(spark: SparkSession, root: str, output: str, version: dt.date | None = None) -> str:
    """Folder of a published output; of its month, for ``monthly`` and ``deltas``."""
    at = read_pointer(spark, root)[output]
    return f"{root}/{at if version is None else at[month_key(version)]}"


def published_month(
    spark: SparkSession, root: str, version: dt.date, output: str = "monthly"
) -> DataFrame:
    """Published rows of the month of ``version``; only that month is read."""
    return spark.read.parquet(published_path(spark, root, output, version))


def previous_month(spark: SparkSession, root: str, version: dt.date) -> DataFrame:
    """Published rows of the month before."""
    return published_month(spark, root, month_before(version))
