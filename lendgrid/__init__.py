"""lendgrid: a Spark-native engine for building a unified loan ledger.

For one business date the job reads history tables as of that date,
enriches loans through keyed left joins, derives classifications with
Catalyst expressions, unions the loan systems into one canonical table,
flags each customer's first loan and rewrites that date's slice.

Sub-packages
------------
functions   column expressions (date normalisation, decode tables, text, money)
sources     as-of snapshot reads, event windows, history derivation, slice writes
operators   frame-level operators (latest-per-key, key-checked lookups, flags,
            pre-aggregated joins, ledger union and first-loan flag)
plans       the operators bound to concrete tables: the registered queries
"""

from lendgrid.rundate import RunDate

__all__ = ["RunDate"]
