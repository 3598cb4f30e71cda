"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_QUERIES  comma-separated names, or "all" for the whole catalogue
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from loomwork.catalog import REGISTRY  # noqa: E402
from loomwork.session import build_session  # noqa: E402

HEADLINE = [
    "segment_metrics",
    "grouped_stats",
    "count_distinct_by_key",
    "month_over_month",
    "join_inner",
    "join_left",
    "join_full",
    "join_semi",
    "join_anti",
    "denormalised",
    "customer_totals_left",
    "row_key_global",
    "row_key_per_customer",
    "top_three_global",
    "top_three_per_customer",
    "rank_compare",
    "second_highest",
    "purchase_pattern",
    "dedup_rows",
    "dedup_best",
    "fill_replace_chain",
    "quality_report",
    "correlation_covariance",
    "subtract",
    "union_distinct",
    "upsert_by_key",
    "word_count",
    "positional_zip",
    "csv_clean",
    "partitions_overwritten",
    "stream_filter",
    "stream_latest_by_key",
    "batch_age_metrics",
    "join_inner_split",
    "join_full_split",
    "numbers_split",
    "ranks_split",
    "lag_lead_split",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    asked = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not asked else sorted(REGISTRY) if asked == "all" else asked.split(",")

    spark = build_session(
        "loomwork bench",
        master=f"local[{cpus}]",
        conf={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": str(os.cpu_count() if cpus == "*" else cpus),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up costs of the session are not a query's.
    REGISTRY["grouped_stats"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("/sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
