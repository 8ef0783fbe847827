"""Python models run where only the driver can import the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
sys.path.insert(0, {REPO!r})
import __spark_entry__ as entry
for name in ("backtest_python", "model_forecasts"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_executors_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
        timeout=300,
    )
    assert "backtest_python 3000" in done.stdout, done.stderr[-2000:]
    assert "model_forecasts 6000" in done.stdout
