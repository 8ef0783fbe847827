"""Time every registered query; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Queries named on the command line run
alone. Each result is computed in full and thrown away (``noop`` sink).

Most queries derive their planning tables from the test tables, which takes longer than the operator.
``stored_queries`` therefore times the operators again, on planning tables that were written first.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from demandmill.plans import inputs
from demandmill.plans.catalog import QUERIES
from demandmill.session import local_session, shared_dir

STORED_INPUTS = (
    "forecast_monthly", "leadtimes", "actuals", "segments", "weekly_raw", "history_wide",
    "accuracy_report", "stat_report", "month_end_raw", "month_end_deltas", "snapshot_history",
)
STORED_QUERIES = (
    "pos_accuracy_by_view", "pos_base", "pos_by_segment", "hierarchy_tree", "clean_inventory",
    "weekly_to_monthly", "month_end_rework", "month_over_month_top10", "forecast_snapshot",
    "history_series", "backtest_naive", "model_forecasts_native", "scoring_rows",
    "scoring_model_summary", "sku_detail_nested",
)


def timed(spark, sf_dir: str, names) -> dict[str, float]:
    took = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
        print(f"{name:32s} {took[name]:8.2f}", file=sys.stderr, flush=True)
    return took


def store_inputs(spark, sf_dir: str) -> None:
    """Write the planning tables once; from then on ``inputs`` reads them."""
    root = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"
    for name in STORED_INPUTS:
        path = f"{root}/{name}"
        getattr(inputs, name)(spark, sf_dir).write.parquet(path)
        setattr(inputs, name, lambda s, d, p=path: s.read.parquet(p))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    # One untimed query starts the JVM's code paths.
    QUERIES["strict_sum"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = timed(spark, sf_dir, sys.argv[1:] or QUERIES)
    stored = {}
    if not sys.argv[1:]:
        store_inputs(spark, sf_dir)
        stored = timed(spark, sf_dir, STORED_QUERIES)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "stored_queries": stored,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
