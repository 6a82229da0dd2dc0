"""Time the headline queries over whole tables and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] (default 8). Each time covers building the plan
and computing every output row; results are discarded by the noop sink.
"""

from __future__ import annotations

import json
import os
import re
import time

from stayline.plans.queries import QUERIES
from stayline.session import build_session

HEADLINE = (
    "ml_feature_store",
    "ml_feature_store_stored",
    "fct_watch_event",
    "fct_daily_user_activity",
    "fct_subscription_event",
    "fct_support_interaction",
    "dim_content",
    "feat_watch",
    "feat_watch_recent",
    "dq_report",
    "null_rate_profile",
    "catalog_flatten",
    "user_title_summary",
    "watchlist_watched_flag",
    "genre_pool",
    "feature_medians",
    "stratified_folds",
    "roc_auc",
    "average_precision",
    "top_risk_customers",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up is not part of any query: load the engine's classes with a small one that is not among the headlines.
    QUERIES["feat_customer"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
