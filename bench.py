"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1) and BENCH_CPUS the
number of local threads.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from duecast.plans.catalog import QUERIES  # noqa: E402
from duecast.plans.session import STATIC_SETTINGS, tuned  # noqa: E402

HEADLINE = [
    "clean_invoices",
    "settle_stage1",
    "ledger_lines",
    "ledger_facts",
    "partner_features",
    "ledger_features",
    "feature_snapshot",
    "cleaning_stats",
    "class_interleave",
    "kfold_assign",
    "roc_curve",
    "lasso_path",
    "score_features",
    "cashflow_forecast",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("duecast-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in STATIC_SETTINGS.items():
        builder = builder.config(key, value)
    spark = tuned(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
