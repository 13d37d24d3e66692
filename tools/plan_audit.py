"""Static plan audit of the registered queries.

    python tools/plan_audit.py [--sf-dir DIR] [key ...]

For each query: number of shuffle exchanges, broadcasts, and warnings for plan shapes
that do not scale (nested-loop or cartesian joins, Python evaluation, a single-partition
exchange, scans that read every column).
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RISKY = {
    "BroadcastNestedLoopJoin": "nested-loop join",
    "CartesianProduct": "cartesian product",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "pandas UDF",
    "SinglePartition": "single-partition exchange",
}


def audit(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan))
    broadcasts = plan.count("BroadcastExchange")
    warn = [v for k, v in RISKY.items() if k in plan]
    return shuffles, broadcasts, warn, plan


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from hrflow.plans import catalog
    from hrflow.session import build_session
    spark = build_session()
    qs = catalog.queries()
    for k in a.keys or list(qs):
        df = qs[k](spark, a.sf_dir)
        s, b, w, plan = audit(df)
        print(f"{k:28s} shuffles={s:2d} broadcasts={b:2d} {'WARN ' + ', '.join(w) if w else ''}")
        if a.show:
            df.explain("formatted")


if __name__ == "__main__":
    main()
