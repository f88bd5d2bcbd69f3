"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: ``{"metric", "value", "unit", "queries", "sf"}``.
Each query is built (its fit aggregates run here) and then fully executed
into Spark's no-op sink, so the time covers the whole plan without a
driver-side collect of large results.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "band_summary",
    "band_assign",
    "metric_all",
    "segment_performance",
    "calibration_quantile",
    "psi_score",
    "psi_features",
    "temporal_summary",
    "monitor_by_period",
    "approval",
    "split_stratified",
    "subsample",
    "clean_pipeline",
    "enc_frequency",
    "enc_target_kfold",
    "impute_clip",
    "scale",
    "join_labels",
    "recalibrate",
    "train_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]

    from lendspark.session import build_session
    from lendspark.plans.registry import queries
    from lendspark.sources import fixtures

    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=max(8, 2 * cpus),
        extra_conf={"spark.driver.memory": "16g"},
    )

    # Warm-up (JIT, class loading) outside the timings.
    fixtures.scored(spark, sf_dir).groupBy("grade").count().collect()
    fixtures.loans_raw(spark, sf_dir).write.format("noop").mode("overwrite").save()

    q = queries()
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.time()
        df = q[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
