"""Source-system segments of the ledger on their own input schemas.

Each segment is a function ``(catalog, run) -> DataFrame`` returning ledger
columns (by name) for one lending system; ``lendgrid.job.LedgerJob`` unions
them, flags first loans and writes the slice.
"""

from lendgrid.segments.bills import bill_loans
from lendgrid.segments.catalog import Catalog, Choices
from lendgrid.segments.corporate import corporate_loans
from lendgrid.segments.detail import loan_detail
from lendgrid.segments.micro import micro_loans
from lendgrid.segments.online import online_loans
from lendgrid.segments.personal import personal_loans
from lendgrid.segments.tax import tax_loans

# Segments in load order.
SEGMENTS = {"CL_1": corporate_loans, "PL_2": personal_loans, "NL_3": online_loans, "WBYXNL_4": tax_loans,
            "BS_5": bill_loans, "XL_6": micro_loans}

__all__ = ["SEGMENTS", "Catalog", "Choices", "bill_loans", "corporate_loans", "loan_detail", "micro_loans", "online_loans",
           "personal_loans", "tax_loans"]
