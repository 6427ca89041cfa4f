"""Timed headline queries; prints one JSON line.

Each query runs to completion over whole tables and its rows are discarded. A first
untimed query starts the engine; every headline query is then timed on its first run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import REGISTRY
from noticeflow.session import build_session

HEADLINE = [
    "person_dedup", "dedup_incremental", "latest_report", "report_filter", "facet_city",
    "extract_dates", "extract_dates_documents", "backfill_dates", "split_name", "parse_date",
    "extract_json", "extract_state_json", "extract_links", "page_text", "enrich_merge",
    "insert_ignore", "new_urls", "run_log", "backfill_city", "markets_build", "markets_merge",
    "daily_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["obit_count"](spark, sf_dir).collect()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
