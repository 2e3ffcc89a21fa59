"""Print executed (adaptive) physical plans of registered queries.

Usage: python tools/explain_plans.py SF_DIR name [name ...]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vodlens.plans.catalog import QUERIES  # noqa: E402
from vodlens.session import get_spark  # noqa: E402


def main(argv):
    sf_dir, names = argv[0], argv[1:]
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # run it, so AQE's final plan is shown
        print(f"## {n}\n")
        print("```")
        print(df._jdf.queryExecution().executedPlan().toString())
        print("```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
