"""Print the operators of a query's physical plan that matter at scale.

    python tests/show_plans.py [--sf DIR] key [key ...]

Shows exchanges, joins, aggregates, subqueries, scans (pushed filters and read
schema) of the final adaptive plan (after AQE's runtime changes), so the query
is executed once and its rows collected; use it on small scale factors.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.queries import QUERIES  # noqa: E402
from strata.session import local_session  # noqa: E402

KEEP = re.compile(
    r"(Exchange|BroadcastExchange|HashJoin|SortMergeJoin|NestedLoop|Cartesian|Aggregate|Subquery|Scan |"
    r"PushedFilters|ReadSchema|AQEShuffleRead|Union)"
)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("keys", nargs="+")
    args = ap.parse_args()
    spark = local_session(8, 8)
    for key in args.keys:
        df = QUERIES[key](spark, args.sf)
        df.collect()  # runs through the frame's own query execution: the final adaptive plan is kept
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"=== {key}")
        for line in plan.splitlines():
            if KEEP.search(line):
                line = re.sub(r"#\d+L?", "", line)
                print(line[:220])


if __name__ == "__main__":
    main()
