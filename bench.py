"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tapeline.queries import all_queries  # noqa: E402
from tapeline.session import build_session, clear_work  # noqa: E402

HEADLINE = (
    "c01_objective_features", "c02_snapshot_derivation", "c03_overnight_scores", "k02_channel_top3", "a12_outcome_summary", "w16_percentile_ranks",
    "c07_pin_scan", "j06_name_mentions", "j05_visible_messages", "c08_enriched_news", "c09_normalized_news", "c10_dedup_merge", "c26_keyword_analysis",
    "k06_cursor_page", "j12_index_upsert", "w21_intraday_changes", "w24_failure_streaks", "c17_holdings", "w23_run_versions", "c16_review_context",
    "s09_comma_klines", "s11_roll_news", "s13_page_articles", "c14_social_signals", "u04_calendar_set_algebra", "r09_stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = build_session("tapeline-bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["a22_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        clear_work(spark)
        seconds[name] = round(statistics.median(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").split("sf")[-1]}))


if __name__ == "__main__":
    main()
