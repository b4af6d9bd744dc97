"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line with per-query seconds. Each query is
fully executed into Spark's no-op sink (no collect to Python).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "wide_build", "wide_summary_service", "wide_summary_year", "conform_drift", "ledger_summary",
    "quality_filter", "stratified_sample", "describe_target", "hist_raw", "topk_values",
    "feature_flags", "one_hot", "gram_matrix", "ridge", "lasso", "gradient_descent",
    "metrics", "error_deciles", "leaderboard_two", "leaderboard", "partition_replace",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cabline.plans.queries import QUERIES
    from cabline.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    t0 = time.time()   # JVM / executor start-up, on data unrelated to the queries
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    warmup = round(time.time() - t0, 3)
    times, fits = {}, {}
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        if name == "leaderboard":     # keep the per-model fit seconds (driver-side solves)
            rows = df.collect()
            fits = {r["model"]: round(r["train_time"], 4) for r in rows if r["type"] != "Baseline"}
        else:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    extra = {}
    if "wide_build" in QUERIES:
        # steady-state throughput of the wide build (second run of the same query; the
        # cold number above includes one-off JVM/codegen start-up)
        rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").count()
        t0 = time.time()
        QUERIES["wide_build"](spark, sf_dir).write.format("noop").mode("overwrite").save()
        warm = time.time() - t0
        extra = {"wide_build_rows": rows, "wide_build_warm_sec": round(warm, 3),
                 "wide_build_rows_per_sec": round(rows / warm)}
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "warmup_sec": warmup, **extra,
                      **({"model_fit_sec": fits} if fits else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
