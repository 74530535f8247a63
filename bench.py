"""Benchmark: wall time of the headline queries at one scale factor.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line. Each query is executed to completion through the
no-op sink (full plan, nothing collected). One untimed run warms the JVM;
a full JVM garbage collection runs (untimed) before each timed query so one
query's garbage is not billed to the next. Each query runs $BENCH_REPEATS times
(default 2) and its best time is reported, which damps local-machine noise.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "tx_user_profile", "churn_contrast", "log_user_agg", "expiry_features", "churn_labels",
    "feature_matrix_v5", "validation_counts", "rate_by_city", "price_describe", "threshold_table",
    "metric_roc_auc", "best_f1", "performance_report", "drift_score", "hourly_by_source",
]

LOG_ROWS = 4_000_000  # daily log rows of the rate measurement


def main() -> None:
    from churnlab.plans.catalog import QUERIES
    from churnlab.session import get_spark, remove_scratch

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        spark.sparkContext._jvm.System.gc()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
        remove_scratch(spark)
        return took

    def log_rate() -> float:
        """Million daily log rows a second through the log aggregate, over the given days copied to more users."""
        from pyspark.sql import functions as F

        from churnlab.operators import features
        from churnlab.plans import bindings
        from churnlab.plans.periods import DEMO_PERIOD as P
        from churnlab.session import materialize
        days = materialize(bindings.user_logs(spark, sf_dir))
        copies = max(1, LOG_ROWS // max(1, days.count()))
        logs = materialize(days.crossJoin(spark.range(copies)).withColumn(
            "msno", F.col("msno") + F.col("id") * 10_000_000).drop("id"))
        n, best = logs.count(), None
        for _ in range(2):
            t0 = time.perf_counter()
            features.log_user_agg(logs, P.log_max_date, P.log_recent, P.log_windows).write.format("noop").mode(
                "overwrite").save()
            best = min(best or 1e9, time.perf_counter() - t0)
        return round(n / best / 1e6, 3)

    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    run("tx_user_profile")  # JVM / codegen warm-up
    times = {n: round(min(run(n) for _ in range(repeats)), 3) for n in names}
    rate = None if sys.argv[1:] else log_rate()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "repeats": repeats,
                      "log_agg_million_rows_per_sec": rate}))


if __name__ == "__main__":
    main()
