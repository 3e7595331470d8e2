"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed in full with the ``noop`` sink (all rows computed,
nothing collected to the driver). ``BENCH_QUERIES`` (comma list) overrides
the query set; ``BENCH_REPEAT`` (default 2) runs each query that many times and keeps the
fastest run, i.e. steady-state time after JIT and codegen warm-up; ``first`` has the first run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "top_players", "stage_players", "game_log_season", "player_performance", "mart_summary",
    "position_leaders", "engineered_features", "stat_trend", "iqr_capped", "quality_rules",
    "quarantine", "describe_stats", "tier_equal_width", "top_scorers", "histogram_points",
    "f_regression", "stratified_split", "class_report", "upsert_latest", "decode_payload",
    "stream_upsert", "etl_run",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))

    from statline.plans.registry import QUERIES
    from statline.session import get_spark

    scratch = tempfile.mkdtemp(prefix="statline-bench-")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                      extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                             "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")

    # warm-up: JVM, codegen caches and the Parquet footer cache
    QUERIES["game_log_career"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    first: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            try:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as e:  # keep benchmarking the rest
                errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
                break
            dt = time.perf_counter() - t0
            first.setdefault(name, round(dt, 3))
            best = dt if best is None else min(best, dt)
        if best is not None:
            times[name] = round(best, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf.group(1)) if sf else sf_dir, "cpus": int(cpus),
           "repeat": repeat, "stat": "min", "first": first}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
