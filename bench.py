"""Times the headline queries and prints one JSON line.

Each query is written to a sink that discards rows, so the whole plan runs and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from millrace.catalog import QUERIES
from millrace.session import build_session

HEADLINE = [
    "dedup_keep_first",
    "dedup_rejects",
    "dedup_keep_last",
    "dup_group_members",
    "merge_upsert_partial",
    "merge_upsert_full",
    "merge_if_changed",
    "merge_contact_only",
    "merge_last_wins",
    "match_new",
    "classify_changes",
    "clean_numeric",
    "clean_date",
    "route_feed",
    "html_kv_table",
    "ledger_filter",
    "file_summary",
    "sip_due",
    "scan_csv_typed",
    "scan_dbf",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in HEADLINE if n in QUERIES]
    for name in ("route_feed", "dedup_keep_first"):  # warm the JVM
        run(spark, sf_dir, name)
    times = {name: round(min(run(spark, sf_dir, name) for _ in range(2)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
