"""Run registered queries in Spark and their SQL oracles in DuckDB on the same
Parquet tables; report row-count / column / value agreement per key.

usage: python scripts/check_oracle.py [--strict] [--tz=Zone/Name] [sf_dir] [key ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lendgrid.plans.compare import run_oracle, compare_rows  # noqa: E402
from lendgrid.plans import ORACLE, QUERIES  # noqa: E402
from lendgrid.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    import lendgrid.plans.compare as cmp

    tz = None
    while argv and argv[0].startswith("--"):
        if argv[0] == "--strict":
            cmp.STRICT = True
        elif argv[0].startswith("--tz="):
            tz = argv[0].split("=", 1)[1]
        argv = argv[1:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or sorted(QUERIES)
    spark = local_session()
    if tz:
        spark.conf.set("spark.sql.session.timeZone", tz)  # results must not depend on it
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = QUERIES[k](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if k not in ORACLE:
            print(f"{k:28s} rows={len(rows):7d} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            ocols, orows = run_oracle(ORACLE[k], sf_dir)
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} ORACLE-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ok, msg = compare_rows(cols, rows, ocols, orows)
        bad += not ok
        print(f"{k:28s} {'OK ' if ok else 'BAD'} rows={len(rows):7d}/{len(orows):7d} {t1 - t0:.1f}s {msg}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
