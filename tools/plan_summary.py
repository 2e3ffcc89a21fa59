"""Per-query shape of the executed (adaptive) plans: shuffle exchanges,
broadcast exchanges, Expand nodes, windows, and Python evaluation nodes.

Usage: python tools/plan_summary.py SF_DIR  (prints a Markdown table)
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vodlens.plans.catalog import QUERIES  # noqa: E402
from vodlens.session import get_spark  # noqa: E402

PY = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def main(sf_dir: str) -> None:
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    print("| query | shuffle exchanges | broadcast exchanges | Expand | Window | Python nodes |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name in QUERIES:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition|rebalance)", plan))
        shuffles += len(re.findall(r"\bShuffleQueryStage\b", plan)) if shuffles == 0 else 0
        bcast = len(re.findall(r"\bBroadcastExchange\b", plan))
        expand = len(re.findall(r"\bExpand\b", plan))
        window = len(re.findall(r"\bWindow(GroupLimit)?\b", plan))
        py = sum(plan.count(p) for p in PY)
        print(f"| `{name}` | {shuffles} | {bcast} | {expand} | {window} | {py} |")


if __name__ == "__main__":
    main(sys.argv[1])
