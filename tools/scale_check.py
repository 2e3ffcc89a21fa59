"""Scale-up check: run reports on larger copies of the driver's tables.

Writes ``events`` replicated ``--factor`` times (new unique event ids, same
value distributions; with ``--hot`` a third of all events moved to one
customer) plus ``customer`` and ``part`` into a scratch folder under
``spark.checkpoint.dir``, then times the chosen registered queries on it.

With ``--no-broadcast`` every dimension is over the broadcast bound, so
customer reports take the pre-aggregate + shuffle-join path.

Usage: python tools/scale_check.py SF_DIR FACTOR [--hot] [--no-broadcast] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from vodlens.plans.catalog import QUERIES  # noqa: E402
from vodlens.session import get_spark, local_path, scratch_path  # noqa: E402

DEFAULT = [
    "vod_by_folder", "vod_by_main_menu", "unique_pageview", "recsys_impressions",
    "recsys_conversion", "submenu_behaviours", "topic_lane_funnel", "series_movies",
    "views_day_hour", "top_items_with_titles", "clean_logs_kafka",
]


def main(argv):
    sf_dir, factor = argv[0], int(argv[1])
    hot = "--hot" in argv
    names = [a for a in argv[2:] if not a.startswith("--")] or DEFAULT
    spark = get_spark(master="local[8]", shuffle_partitions=64)
    if "--no-broadcast" in argv:
        spark.conf.set("vodlens.broadcast.maxRows", "0")
    out = scratch_path(spark, f"scale{factor}")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = ev.agg(F.max("event_id")).collect()[0][0] + 1
    rep = ev.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    rep = rep.withColumn("event_id", F.col("event_id") + F.col("r") * F.lit(n)).drop("r")
    if hot:
        rep = rep.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    rep.repartition(32).write.mode("overwrite").parquet(f"{out}/events.parquet")
    for t in ("customer", "part"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.mode("overwrite").parquet(f"{out}/{t}.parquet")
    rows = spark.read.parquet(f"{out}/events.parquet").count()
    times = {}
    QUERIES["vod_by_folder"](spark, out).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, out).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 2)
    print(json.dumps({"factor": factor, "hot": hot, "broadcast": "--no-broadcast" not in argv, "events": rows, "seconds": times,
                      "total": round(sum(times.values()), 2), "path": local_path(out)}))


if __name__ == "__main__":
    main(sys.argv[1:])
