"""Headline queries on one machine: prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every query is run once to
warm up and then timed, from building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import time

from pulsegrid.plans.queries import QUERIES
from pulsegrid.session import clear_scratch, local_session

HEADLINE = (
    "f1_log_flatten",
    "f2_span_flatten",
    "f3_metric_flatten",
    "f4_feature_documents",
    "r4_fanout",
    "r8_quarantine",
    "h1_history",
    "h2_last_n",
    "a13_enhanced_snapshot",
    "a8_distributed_quantiles",
    "a14_trend",
    "a15_aggregated_row",
    "a22_infra_health",
    "a30_correlation",
    "w1_window_grid",
    "w2_sliding_at_messages",
    "w6_sliding_snapshot",
    "w9_enhanced_at_messages",
    "q1_topics",
    "q2_enhanced_stats",
    "q3_trends",
    "q5_count_5s",
    "a31_batch_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(
        "bench", cores, **{"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": cores,
                           "spark.ui.showConsoleProgress": "false"}
    )
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
