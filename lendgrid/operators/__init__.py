"""Frame-level operators built from DataFrame primitives."""

from lendgrid.operators.aggregates import agg_join, collect_concat, ordered_concat
from lendgrid.operators.attach import Lookup, attach_many
from lendgrid.operators.flags import exists_flag, having_multi, membership_flag
from lendgrid.operators.latest import first_flag, first_last_aggs, latest_by, top1_by_max
from lendgrid.operators.ledger import flag_first_loan, union_segments
from lendgrid.operators.lookup import code_map, code_values, coalesce_lookup, lookup_unique
from lendgrid.operators.skew import split_left_join

__all__ = [
    "Lookup",
    "agg_join",
    "attach_many",
    "coalesce_lookup",
    "code_map",
    "code_values",
    "collect_concat",
    "exists_flag",
    "first_flag",
    "first_last_aggs",
    "flag_first_loan",
    "having_multi",
    "latest_by",
    "lookup_unique",
    "membership_flag",
    "ordered_concat",
    "split_left_join",
    "top1_by_max",
    "union_segments",
]
