"""Benchmark the headline queries.

Runs each registered query on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line.
Every query is fully executed through the ``noop`` sink (all rows
produced, nothing collected); the first run of each query is a warm-up
only when ``BENCH_WARMUP=1``. Session start-up (executors, Python
workers, codegen) is paid once by two untimed queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.testbed import REGISTRY  # noqa: E402
from strata.session import get_spark  # noqa: E402

HEADLINE = [
    "overview", "share_of_total", "share_within", "group_profile", "group_profile_expr", "profile_join",
    "outcome_rate", "numeric_stats", "banded_profile", "top_groups", "top_k", "shared_keys", "missing_by_group",
    "value_counts", "crosstab", "describe", "describe_all", "box_stats", "hist_width", "missing_profile",
    "duplicates", "duplicate_ids", "type_profile", "filter_spec", "unpivot", "text_keys", "title_surname",
    "harmonize", "overlap_audit", "nonoverlap", "split_counts", "fold_counts", "confusion", "class_report",
    "score_columns", "passenger_03_class_profile", "passenger_20_potential_duplicate_tickets", "passenger_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if os.environ.get("BENCH_ALL") == "1":  # every registered query that does not fit models
        names = [n for n, r in REGISTRY.items() if r.oracle]
    spark = get_spark("strata-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra_conf={"spark.driver.memory": "16g"})
    # start executors, Python workers and codegen once, outside the timings
    REGISTRY["group_profile"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    REGISTRY["text_keys"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    failed = []
    for name in names:
        build = REGISTRY[name].build
        try:
            if os.environ.get("BENCH_WARMUP") == "1":
                build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            t0 = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - record and keep measuring the rest
            timings[name] = None
            failed.append(f"{name}: {type(exc).__name__}")
    sf_text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_text)
    except ValueError:
        sf = sf_text
    result = {"metric": "total_query_seconds", "value": round(sum(v for v in timings.values() if v is not None), 3),
              "unit": "sec", "queries": timings, "sf": sf}
    if failed:
        result["failed"] = failed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
