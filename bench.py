"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local threads. Each query runs
once to warm up and then BENCH_RUNS times into a sink that discards rows; the median is reported.
A run includes writing the files or archives that the query reads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerline.workload import QUERIES  # noqa: E402

HEADLINE = (
    "exceptions_report",
    "id_map_resolved",
    "merge_trades",
    "merge_daily_process",
    "merge_archive",
    "merge_holdings",
    "merge_audit",
    "lines_from_documents",
    "lines_numbered",
    "mask_fixed",
    "mask_fixed_wide",
    "mask_delimited",
    "mask_by_layout",
    "mask_audit",
    "customers_multi",
    "customers_by_field",
    "split_document_sections",
    "search_lines",
    "search_zip",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
