"""Times the headline queries and prints one JSON line.

Every query runs once to warm up and once on the clock; all result columns are
computed and thrown away.  Environment: ``BENCH_SF_DIR``, ``BENCH_CPUS``, and
``BENCH_QUERIES`` (comma-separated names, or ``all``).
"""

from __future__ import annotations

import json
import os
import sys
import time

from civicpanel.catalogue import QUERIES
from civicpanel.session import build_session

HEADLINE = [
    "scan_project", "partition_range", "parse_brl", "safe_cast_rejects", "expand_levels", "rollup_levels",
    "big_number", "resolve_fallback", "or_key_join", "join_full", "preagg_join", "group_sum",
    "distinct_by_level", "pivot_sum", "dedupe_sum", "deficit_score", "majority_group", "latest_per_key",
    "dense_id", "with_total", "unpivot_periods", "pair_report", "unique_key", "fanout_guard",
    "panel_transfers", "panel_offer", "panel_survey", "panel_works", "panel_infra", "panel_census",
    "panel_adhesion", "transition_rollup", "panel_budget", "wide_report",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> int:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "civicpanel-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(run(spark, name, folder), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
