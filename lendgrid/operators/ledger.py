"""The canonical loan ledger: schema, segment union and first-loan flag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendgrid.operators.latest import first_flag, latest_by

# The 137 ledger column names, in the order in which the loads
# first name them, and the six segment tags in load order.
LEDGER_COLUMNS = (
    "acct_num acct_sts acct_sts_fhz acct_sts_xmdk acct_typ acct_typ_desc accu_int_amt accu_int_flg "
    "actual_maturity_dt base_int_rat book_type campus_consu_loan_flg cancel_flg circle_loan_flg "
    "consecute_term_num cumulate_term_num current_term_num curr_cd cust_id data_date date_sourcesd "
    "departmentd drawdown_amt drawdown_base_int_rat drawdown_dt drawdown_real_int_rat drawdown_type "
    "drawdown_type_new emp_id entrust_pay_amt extendterm_flg finish_dt float_type fund_use_loc_cd "
    "generalize_loan_flg sp_prov_amt gov_bondmorg_flg green_loan_flg green_loan_type guaranty_typ "
    "independence_pay_amt indust_stg_type indust_tran_flg internet_loan_flg int_rate_typ int_repay_freq "
    "int_repay_freq_desc is_first_report_loan_tag is_repay_options item_cd i_od_dt loans_to_culture_flag "
    "loan_acct_bal loan_acct_bank loan_acct_name loan_acct_num loan_business_typ loan_buy_int loan_fhz_num "
    "loan_grade_cd loan_kind_cd loan_num loan_num_old loan_purpose_area loan_purpose_cd "
    "loan_purpose_country_new loan_ratio loan_sell_int low_risk_flag main_guaranty_typ maturity_dt "
    "year_int_incom next_int_pay_dt next_repricing_dt od_days od_flg od_int od_int_obs od_loan_acct_bal "
    "org_num orig_acct_no orig_term orig_term_type oversea_ann_loan_flag pay_acct_bank pay_acct_num "
    "pftz_loan_flg poverty_alle pricing_base_type p_od_dt real_int_rat renew_flg repay_flg repay_term_num "
    "repay_typ repay_typ_desc security_acct_num security_amt security_curr security_rate tax_related_flg "
    "transfers_loan_flg undertak_guar_type useofunds yangtze_river_loan_flg loan_purpose_country "
    "ppl_repay_freq int_adjest_amt remark orig_term_bc drawdown_num guaranty_typ_js cust_id_js "
    "product_type_js lcstatus acct_num_cqcs consume_loan_add_type green_balance green_purpose_cd "
    "in_drawdown_dt mon_int_incom resched_flg acct_typ_js od_type_js loan_status_js loan_type_js "
    "acct_sts_desc comp_int_typ housmort_loan_typ resched_end_dt discount_interest draft_nbr int_num_date "
    "drawdown_type_desc is_first_loan_tag loan_resched_dt useofunds_js"
).split()
SEGMENT_TAGS = ("CL_1", "PL_2", "NL_3", "WBYXNL_4", "BS_5", "XL_6")

AMOUNT = T.DecimalType(20, 2)
RATE = T.DecimalType(12, 6)

_AMOUNT_NAMES = {"od_int", "od_int_obs", "discount_interest",
                 "security_amt", "year_int_incom", "mon_int_incom", "int_adjest_amt", "green_balance",
                 "od_loan_acct_bal", "loan_acct_bal", "sp_prov_amt"}
_RATE_NAMES = {"security_rate"}
# flags and percent text whose names look numeric
_TEXT_NAMES = {"loan_buy_int", "loan_sell_int", "loan_ratio"}
_INT_NAMES = {"consecute_term_num", "cumulate_term_num", "current_term_num", "repay_term_num",
              "od_days", "orig_term", "orig_term_bc"}


def _ledger_type(name: str) -> T.DataType:
    if name in _TEXT_NAMES:
        return T.StringType()
    if name in _INT_NAMES:
        return T.IntegerType()
    if name in _AMOUNT_NAMES or name.endswith("_amt"):
        return AMOUNT
    if name in _RATE_NAMES or name.endswith("_rat"):
        return RATE
    if name.endswith("_dt") and name != "data_date":
        return T.DateType()
    return T.StringType()


LEDGER = T.StructType([T.StructField(c, _ledger_type(c), True) for c in LEDGER_COLUMNS])


def conform(df: DataFrame, schema: T.StructType = LEDGER, fill_missing: bool = True) -> DataFrame:
    """Project a frame onto ``schema`` by name: missing columns become typed
    NULLs (or are left out with ``fill_missing=False``), extra columns are
    dropped, every column is cast to its type.

    Built as one list of SQL expressions (a single call into the JVM) rather
    than one Column object per field: the ledger is 137 columns wide."""
    have = {c.lower(): c for c in df.columns}
    exprs = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None and not fill_missing:
            continue
        value = f"`{src}`" if src is not None else "NULL"
        exprs.append(f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`")
    return df.selectExpr(*exprs)


def union_segments(segments: Mapping[str, DataFrame], data_date: str,
                   schema: T.StructType = LEDGER) -> DataFrame:
    """Tag each segment with its source, conform it to the ledger schema
    (columns it does not fill become typed NULLs, every column is cast to its
    ledger type) and union the segments by name. Conforming before the union
    means no implicit type widening between segments. No shuffle: a union
    only concatenates partitions."""
    out = None
    for tag, seg in segments.items():
        tagged = conform(seg.withColumn("date_sourcesd", F.lit(tag)).withColumn("data_date", F.lit(data_date)), schema)
        out = tagged if out is None else out.unionByName(tagged)
    return out


def split_segments(base: DataFrame, specs: Sequence[tuple[str, Column, Mapping[str, Column]]],
                   data_date: str, schema: T.StructType | None = LEDGER) -> DataFrame:
    """Ledger rows for segments carved out of ONE input by disjoint
    predicates, in a single pass.

    Equivalent to ``union_segments`` over ``base.where(pred).select(cols)``
    per segment, but the input (and any aggregate feeding it) is scanned
    once: the row's tag is the first matching predicate and every column is
    a ``CASE`` over the tag, NULL where the segment does not fill it.
    ``specs`` is ``[(tag, predicate, {column: expression}), ...]``.
    """
    tag = None
    for t, pred, _ in specs:
        tag = F.when(pred, F.lit(t)) if tag is None else tag.when(pred, F.lit(t))
    tagged = base.withColumn("date_sourcesd", tag).where(F.col("date_sourcesd").isNotNull())
    names = list(dict.fromkeys(c for _, _, cols in specs for c in cols))
    out = []
    for name in names:
        expr = None
        for t, _, cols in specs:
            if name in cols:
                cond = F.col("date_sourcesd") == t
                expr = F.when(cond, cols[name]) if expr is None else expr.when(cond, cols[name])
        out.append(expr.alias(name))
    rows = tagged.select("date_sourcesd", *out).withColumn("data_date", F.lit(data_date))
    return conform(rows, schema) if schema is not None else rows


def first_loans(rows: DataFrame, cust: str = "cust_id", order: tuple[str, ...] = ("drawdown_dt", "loan_num"),
                row_key: tuple[str, ...] = ("loan_num", "date_sourcesd")) -> DataFrame:
    """The row keys of each customer's first loan across all sources (``flag_first_loan`` marks
    these rows): a top-1 per customer, so a customer's rows never meet in one task."""
    extra = [k for k in row_key if k not in order]
    firsts = latest_by(rows.select(cust, *order, *extra), [cust], [F.col(c).asc_nulls_last() for c in [*order, *extra]])
    return firsts.select(*row_key).dropna().distinct()


def flag_first_loan(ledger: DataFrame, flag: str = "is_first_report_loan_tag",
                    cust: str = "cust_id", order: tuple[str, ...] = ("drawdown_dt", "loan_num"),
                    row_key: tuple[str, ...] = ("loan_num", "date_sourcesd")) -> DataFrame:
    """Mark each customer's first loan across all sources with ``Y`` (the rest
    keep their own value, ``N`` when unset), computed before the write
    instead of a MERGE on the written slice. Works on any frame holding the
    key columns; flag before widening a frame to the full ledger when
    possible, so the join shuffles narrow rows."""
    # ranked per customer, matched back on the row key (the source's MERGE
    # matches on loan number and source only)
    flagged = first_flag(ledger, [cust], list(order), list(row_key), "__first", match_group=False)
    own = f"`{flag}`" if flag in ledger.columns else "NULL"
    value = f"CASE WHEN __first = 'Y' THEN 'Y' ELSE COALESCE({own}, 'N') END AS `{flag}`"
    cols = [value if c == flag else f"`{c}`" for c in ledger.columns]
    if flag not in ledger.columns:
        cols.append(value)
    return flagged.selectExpr(*cols)
