"""Audit the physical plan of every registered query: no cartesian or
nested-loop joins, every Parquet scan prunes columns, and count exchanges,
broadcasts and pushed filters.

usage: python scripts/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lendgrid.plans import QUERIES  # noqa: E402
from lendgrid.session import local_session  # noqa: E402

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


def audit(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        "bad": [b for b in BAD if b in plan],
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "scans": plan.count("FileScan parquet"),
        "codegen": plan.count("*("),
    }


def main(argv):
    markdown = "--markdown" in argv
    argv = [a for a in argv if a != "--markdown"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # audit the static plan
    bad = 0
    if markdown:
        print("| key | shuffles | broadcasts | scans | scans with pushed filters | codegen stages | cartesian / nested loop |")
        print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in sorted(QUERIES):
        a = audit(QUERIES[name](spark, sf_dir))
        bad += bool(a["bad"])
        if markdown:
            print(f"| `{name}` | {a['exchanges']} | {a['broadcasts']} | {a['scans']} | {a['pushed']} | {a['codegen']} | "
                  f"{', '.join(a['bad']) or 'none'} |")
        else:
            print(f"{name:24s} {a}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
