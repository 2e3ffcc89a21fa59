"""Benchmark: run every registered query at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]`` and print one JSON line.

Each query is executed in full with the ``noop`` sink (all stages run, no rows
travel to the driver).  Session start-up and one warm-up query are excluded.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from vodlens.plans.catalog import QUERIES
    from vodlens.session import get_spark

    spark = get_spark(
        app="vodlens-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"},
    )

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("vod_by_folder")  # warm-up: JIT, codegen caches, file listing
    times, errors = {}, {}
    for name in only or list(QUERIES):
        try:
            times[name] = round(run(name), 3)
        except Exception as e:  # keep measuring the rest; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "n_queries": len(times),
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
