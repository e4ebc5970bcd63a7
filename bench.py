"""Headline queries, timed end to end; prints one JSON line.

Reads ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on
``local[$BENCH_CPUS]``.  Every query runs over its whole tables and writes its
full result to a sink that discards it.  Each runs twice, from building the plan
to the last row, with nothing cached, and the faster run counts: the first one also
pays for starting Python workers and compiling generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalogue import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "weekly_order_activity",
    "fuzzy_matched_usage",
    "fuzzy_pairs",
    "cleaned_usage",
    "financial_timeline",
    "merged_sources",
    "weekly_features",
    "feature_dataset",
    "training_table",
    "live_feature_dataset",
    "churn_summary",
    "weekly_active",
    "activity_tiers",
    "price_quantiles_by_status",
    "stratified_split",
    "datasets_compared",
    "inferred_types",
    "column_profile",
    "trend_health",
    "lowess_by_segment",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cores, partitions=max(8, int(cores) if cores.isdigit() else 8))
    QUERIES["weekly_order_activity"].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            spark.catalog.clearCache()
            start = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
