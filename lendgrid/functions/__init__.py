"""Column expressions. Everything here returns a ``Column`` built from Spark
built-ins, so it stays inside whole-stage codegen (no Python UDFs)."""

from lendgrid.functions.codes import case_map, decode, in_code_set, prefix_map
from lendgrid.functions.dates import (
    coalesce_dates,
    date_lit,
    date_texts,
    norm_date,
    overdue_days,
    term_months,
    text_date_between,
)
from lendgrid.functions.money import effective_rate, money, money_sum, rate
from lendgrid.functions.text import concat_null_as_empty, rate_text, substr1, text_after

__all__ = [
    "case_map",
    "coalesce_dates",
    "concat_null_as_empty",
    "date_lit",
    "date_texts",
    "decode",
    "effective_rate",
    "in_code_set",
    "money",
    "money_sum",
    "norm_date",
    "overdue_days",
    "prefix_map",
    "rate",
    "rate_text",
    "substr1",
    "term_months",
    "text_after",
    "text_date_between",
]
