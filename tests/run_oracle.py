"""Command line: compare every catalogue key (or the ones named) against DuckDB.

    python tests/run_oracle.py [--sf /root/testdata/sf0.01] [key ...]
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.oracle_sql import ORACLE  # noqa: E402
from strata.plans.queries import QUERIES  # noqa: E402
from strata.session import local_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--exact", action="store_true", help="floats must be equal, not just close")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    spark = local_session(8, 8)
    con = duck(args.sf)
    bad = 0
    for key in args.keys or list(QUERIES):
        if key not in ORACLE:
            print(json.dumps({"key": key, "oracle": "none"}))
            continue
        t = time.time()
        try:
            res = compare(spark, QUERIES[key], ORACLE[key], args.sf, con, exact=args.exact)
        except Exception as exc:  # report and go on with the next key
            res = {"error": f"{type(exc).__name__}: {str(exc)[:600]}", "values_match": False}
        res["key"] = key
        res["sec"] = round(time.time() - t, 2)
        bad += not res.get("values_match")
        print(json.dumps(res), flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
