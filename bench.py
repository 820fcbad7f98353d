"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulse.plans.all_queries import QUERIES  # noqa: E402
from pulse.session import drop_intermediates, local_session  # noqa: E402

HEADLINE = [
    "platform_averages", "location_engagement", "top_five_percent", "relative_leaders", "monthly_growth",
    "user_rollup", "kpis", "clean_posts", "clean_users", "clean_and_roll_up", "change_log", "text_clean_nlp",
    "negation_scope", "daily_spikes", "hourly_spikes", "daily_shifts", "nearest_trigger", "event_hypotheses",
    "aspect_sentiment", "trending_terms", "weekly_entities", "profile_report", "correlation_matrix",
    "outlier_summary", "leaked_ids", "near_duplicate_sets", "split_80_20", "overall_metrics", "ranking_scores",
    "threshold_sweep", "tfidf", "stream_daily_activity", "model_comparison",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    QUERIES["platform_averages"](spark, folder).collect()  # start the engine outside the clock
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        drop_intermediates(spark)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
