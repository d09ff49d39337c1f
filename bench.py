"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8): one warm-up
run, then the median of three timed runs (``WRITES``: one run).  A run executes the whole plan
and discards the rows in Spark's ``noop`` sink (no collect to Python), so
the time is the engine's.  Prints ONE JSON line (and each query's time, as it
ends, to stderr); a query that fails is listed under ``errors``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from emporia.plans import registry  # noqa: E402
from emporia.session import build_session  # noqa: E402

HEADLINE = (
    "mart_user_activity",
    "mart_product_performances",
    "mart_customer_characteristics",
    "mart_lost_revenue",
    "agg_count_nonnull_vs_distinct",
    "agg_sum_avg_min_max",
    "agg_safe_ratio",
    "agg_group_by_month",
)

#: queries that write tables: timed once, as each run writes anew
WRITES = (
    "ingest_csv_order_item",
    "merge_order_item",
    "load_audit",
    "backfill_orders",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or [*HEADLINE, *WRITES]
    spark = build_session(
        master=f"local[{cpus}]",
        app_name="emporia-bench",
        shuffle_partitions=max(8, 2 * cpus),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            if name not in WRITES:
                run_once(spark, name, sf_dir)  # warm-up (JIT, file listing caches)
            runs = 1 if name in WRITES else repeats
            times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
        except Exception as failure:  # the other queries' figures count all the same
            errors[name] = str(failure).splitlines()[0][:300]
        print(f"{name}: {times.get(name, errors.get(name))}", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_median",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "sink": "noop",
                **({"errors": errors} if errors else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
