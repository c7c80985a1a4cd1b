"""Benchmark: runs the headline queries on $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS] and prints ONE JSON line.

Each query is executed end to end into Spark's ``noop`` sink (full plan, no
collection to the driver); the reported time per query is wall-clock
seconds of that execution, including any actions the operator itself needs
(quantile buckets, checkpoints, model fits)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "features_ride", "features_food", "sessions_batch", "pit_history_batch", "txn_features",
    "location_features", "saved_place_flags", "time_parts", "pr_curve", "roc_auc", "ece",
    "threshold_sweep", "classification_report", "isotonic_apply", "stratified_sample",
    "training_rows",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [a for a in sys.argv[1:]] or list(HEADLINE)

    from cohortkit.session import build_session
    from cohortkit.plans.registry import REGISTRY

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="bench")
    per: dict[str, float] = {}
    for name in names:
        q = REGISTRY[name]
        t0 = time.perf_counter()
        q.spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        per[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(per.values()), 3),
                      "unit": "sec", "queries": per,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
