"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query seconds.

Each query is executed in full with the ``noop`` sink (all rows computed, none
shipped to the driver); the reported time per query is the best of
$BENCH_REPEAT runs (default 2: one cold, one warm). One untimed warm-up query
runs first so JVM start-up and JIT compilation are not charged to whichever
query happens to be first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lendgrid.plans import QUERIES  # noqa: E402
from lendgrid.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="lendgrid-bench")
    QUERIES["loan_overview"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up, untimed
    times: dict[str, float] = {}
    for name in sorted(QUERIES):
        if only and name not in only:
            continue
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
