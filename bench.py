"""Time the headline queries and print one JSON line.

Every query is run in full into a sink that drops the rows. The time given is
the shorter of two runs, so that it measures the plan and not the start of the JVM.
Model training is timed once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from cardwarden.session import local_session
from checks.queries import QUERIES

HEADLINE = [
    "base_view", "ml_features", "card_aggregates", "email_domain_risk", "rate_by_product",
    "late_night_lift", "fraud_scores", "score_join", "rate_by_risk", "confusion_metrics",
    "roc_auc", "model_comparison", "validate_required", "conform_schema", "dead_letters",
    "route_totals", "score_requests",
]
ONCE = ["train_logistic", "train_boosted"]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    chosen = sys.argv[1:]
    seconds = {}
    for name in chosen or HEADLINE + ONCE:
        runs = 1 if name in ONCE else 2
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
