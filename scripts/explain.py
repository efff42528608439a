"""Print the formatted physical plan of one registered query.

usage: python scripts/explain.py <key> [sf_dir]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lendgrid.plans import QUERIES  # noqa: E402
from lendgrid.session import local_session  # noqa: E402


def main(argv):
    key = argv[0]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    QUERIES[key](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
