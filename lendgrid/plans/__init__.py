"""The ledger operators bound to the driver tables.

Role mapping: ``orders`` are loans (``o_orderdate`` is the draw-down date),
``lineitem`` is the repayment schedule (``l_linenumber`` the period,
``l_shipdate`` the due date), ``customer`` the borrower, ``nation``/``region``
the org and area dimensions, ``part`` the guarantee/product, ``supplier`` the
account registry, and ``events`` a change log from which a half-open history
table is derived. Each registered query has an equivalent DuckDB SQL oracle.
"""

from lendgrid.plans.registry import ORACLE, QUERIES, query

# import the modules so their queries register
from lendgrid.plans import loans as _loans  # noqa: F401,E402
from lendgrid.plans import joins as _joins  # noqa: F401,E402
from lendgrid.plans import classify as _classify  # noqa: F401,E402
from lendgrid.plans import ledger as _ledger  # noqa: F401,E402

__all__ = ["ORACLE", "QUERIES", "query"]
