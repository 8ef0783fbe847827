"""The package on the executors.

Functions that run in Python workers are pickled by reference, so workers must be able to import this
package. Where it is not installed on the cluster, one zip of its sources is added to the session.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the session, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped or not os.path.isdir(ROOT):
        return
    # Only the driver reads this file; Spark hands its bytes to the executors.
    path = os.path.join(tempfile.mkdtemp(prefix="demandmill-"), "demandmill_sources.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(ROOT):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(ROOT)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
