"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of local cores. Every query
is run once to warm up and then timed, as a full write to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskrules.plans.catalog import REGISTRY  # noqa: E402
from riskrules.session import local_session  # noqa: E402

HEADLINES = [
    "dispute_rates",
    "daily_activity",
    "daily_panel",
    "panel_payment_windows",
    "panel_activity_windows",
    "payer_profile",
    "spend_horizons",
    "feature_table",
    "payment_density",
    "session_losses",
    "list_statistics",
    "quantile_bins",
    "univariate_rules_fine",
    "pair_rules",
    "triple_rules",
    "rules_on_test_rows",
    "tree_rules_by_day",
    "score_metrics",
    "gains_curve",
]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("riskrules-bench", cores)
    seconds = {}
    for name in HEADLINES:
        timed(spark, name, folder)
        seconds[name] = round(timed(spark, name, folder), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
