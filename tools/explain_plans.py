"""Print the formatted physical plans of the main queries (for plan review).

    python tools/explain_plans.py /root/testdata/sf0.01 silver_jobs skill_match ...
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from hirelake import catalog
    from hirelake.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or ["silver_jobs", "skill_match", "median_salary_by_role"]:
        print(f"==================== {name}")
        catalog.QUERIES[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
