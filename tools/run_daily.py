"""spark-submit entry point for nightly runs and backfills.

    spark-submit --py-files vodlens.zip tools/run_daily.py k,2,10 2024-01-01 [2024-01-07] ...
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vodlens.plans.daily import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
