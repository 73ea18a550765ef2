"""Seconds per headline query on $BENCH_SF_DIR with local[$BENCH_CPUS]: one warm-up, then the median of three runs.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from selenite.session import session  # noqa: E402

HEADLINE = ["verdict_counts", "confidence_recommend", "join_last_wins", "sibling_matches", "overlay_anti_join", "fdr_q", "stress_curve", "top_per_group", "diverse_preview", "group_features", "persistence_summary", "nl_query_bright", "taxonomy", "box_blur", "annulus_field", "components", "sigma_clip_stack", "kernel_measures"]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    from selenite.plans import registry

    took: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            began = time.time()
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
