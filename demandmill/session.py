"""Session for tests and the bench, and the folder that a cluster shares.

On a cluster the caller passes its own session; nothing in the library creates one.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def local_session(cpus: int | str = 8, app: str = "demandmill") -> SparkSession:
    """A local session with the settings the library is tested with."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DEMANDMILL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Reports have up to 120 columns. One generated method over 8000 bytes of bytecode is never
        # compiled by the JVM; under this limit Spark splits such a projection instead.
        .config(METHOD_LIMIT, "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """What is run inside has no generated method over 8000 bytes of bytecode, which the JVM never compiles.

    Spark then splits the projections of wide rows; without it they are interpreted. Results are the same.
    """
    before = spark.conf.get(METHOD_LIMIT, None)
    spark.conf.set(METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(METHOD_LIMIT)
        else:
            spark.conf.set(METHOD_LIMIT, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, named by ``spark.checkpoint.dir``.

    Every executor must see it, so a cluster without the setting is an error. Only a session whose
    executors are threads of the driver (``local``, ``local[n]``) is given a folder of this machine,
    one per session.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if root:
        return root
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor sees")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="demandmill-"))
    return context.getCheckpointDir()


#: Bytes of source files per task of a shuffle that deals out rows derived from them.
BYTES_PER_TASK = 4 << 20


def tasks_for(df: DataFrame) -> int:
    """Tasks among which rows that grow with the files of ``df`` are dealt out.

    At least ``spark.sql.shuffle.partitions``; beyond that one per ``BYTES_PER_TASK`` of the files, so that
    what a task holds stays bounded whatever the setting. The files' sizes are looked up, none is read.
    """
    spark = df.sparkSession
    system, size = spark._jvm.org.apache.hadoop.fs, 0
    for file in set(df.inputFiles()):
        path = system.Path(file)
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BYTES_PER_TASK))


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows written to the shared folder once, for several results that start from them.

    A reliable checkpoint: it is read again after an executor is lost.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
