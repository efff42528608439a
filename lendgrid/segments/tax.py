"""WBYXNL_4: tax-based online loans (one ledger row per loan detail row).

The loan detail table already carries statuses, balances, overdue days and
terms; the segment adds the disbursement application, order and industry
dimensions, per-loan subject balances, repayment-plan counts, interest
collected this year and two code-map translations. Joins that cannot change
a value (the source's unused report/application/account joins) are not
reproduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendgrid.functions import decode, norm_date
from lendgrid.operators import code_map
from lendgrid.rundate import RunDate
from lendgrid.segments.catalog import Catalog

# Source table names.
DETAIL = "OMI.WBYXNL_G_DLYH_LOAN_DETAIL_HS"
APPLY = "OMI.WBYXNL_BUSI_DISB_APPLY_HS"
ORDER = "OMI.WBYXNL_BUSI_ORDER_INFO_HS"
ORDER_EXT = "OMI.WBYXNL_BUSI_ORDER_EXTEND_HS"
ECONOMIC = "OMI.WBYXNL_TD_ECONOMIC_INFO_HS"
REFUND = "OMI.WBYXNL_G_DLYH_REFUND_DETAIL_HS"
ORG_PARAM = "OMI.KN_KBRP_JGCSHU_HS"
IOU_BAL = "OMI.WBYXNL_AMS_L_IOU_BAL_HS"
REPAY_PLAN = "OMI.WBYXNL_G_DLYH_REPAY_PLAN_HS"
CODE_MAP = "M_DICT_REMAPPING_DL"

# Statuses, subjects, dictionary codes and labels.
NORMAL, CLEARED, OVERDUE = "NOR", "CLEAR", "OVD"
ACCT_STS = {NORMAL: "1", CLEARED: "3", OVERDUE: "2"}
OTHER = "其他"
OD_INT_SUBJECT, OD_INT_OBS_SUBJECT, SUBJECT_ORDER = "12010132", "721102", 3
GREEN_TYPE_DICT = "WBYXNL-GREEN_LOAN_PURPOSE-GREEN_LOAN_TYPE"
GREEN_PURPOSE_DICT = "WBYXNL-YJ_GREEN_LOAN_PURPOSE-GREEN_PURPOSE_CD"
MAP_BUSINESS_TYPE = "RSUM"
CONSTANTS = {
    "acct_typ": "010299", "acct_typ_desc": "税闪贷", "accu_int_flg": "Y", "book_type": "2",
    "campus_consu_loan_flg": "N", "circle_loan_flg": "Y", "comp_int_typ": "N", "curr_cd": "CNY",
    "departmentd": "xwdk", "drawdown_type": "A", "extendterm_flg": "N", "fund_use_loc_cd": "I",
    "generalize_loan_flg": "Y", "gov_bondmorg_flg": "N", "guaranty_typ": "D", "internet_loan_flg": "Y",
    "int_adjest_amt": 0, "int_rate_typ": "F", "int_repay_freq": "03", "is_first_report_loan_tag": "N",
    "is_repay_options": "Y", "item_cd": "11050201", "loan_business_typ": "4", "loan_buy_int": "N",
    "loan_purpose_country_new": "CHN", "loan_ratio": "100%", "loan_sell_int": "N", "low_risk_flag": "N",
    "main_guaranty_typ": "3", "orig_term_type": "M", "oversea_ann_loan_flag": "N", "poverty_alle": "N",
    "ppl_repay_freq": "03", "renew_flg": "N", "repay_flg": "N", "repay_typ": "1", "resched_end_dt": None,
    "resched_flg": "N", "tax_related_flg": "Y", "transfers_loan_flg": "N", "useofunds": "生产经营",
    "yangtze_river_loan_flg": "N",
}


def _rename(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def subject_balances(cat: Catalog, run: RunDate) -> DataFrame:
    """Overdue-interest balances per disbursement from two ledger subjects,
    in one filtered aggregate."""
    bal = cat.snapshot(IOU_BAL, run).where(
        (F.col("sub_code_order") == SUBJECT_ORDER) & F.col("sub_code").isin(OD_INT_SUBJECT, OD_INT_OBS_SUBJECT))
    return bal.groupBy(F.col("disb_no").alias("credit_num")).agg(
        F.sum(F.when(F.col("sub_code") == OD_INT_SUBJECT, F.col("sub_bal"))).alias("i1_sub_bal"),
        F.sum(F.when(F.col("sub_code") == OD_INT_OBS_SUBJECT, F.col("sub_bal"))).alias("i2_sub_bal"),
    )


def tax_loans(cat: Catalog, run: RunDate) -> DataFrame:
    g = cat.snapshot(DETAIL, run)
    d = _rename(cat.snapshot(APPLY, run), "d", [
        "credit_num", "contract_code", "base_rate", "is_green_loan", "disb_bank_name", "disb_acct_name",
        "disb_acct", "order_code", "disb_bank_no", "green_loan_purpose", "yj_green_loan_purpose"])
    o = _rename(cat.snapshot(ORDER, run), "o", ["order_code", "order_seq", "customer_manager_number", "region_code"])
    e = _rename(cat.snapshot(ORDER_EXT, run), "e", ["order_seq", "industry_sub_code"])
    ted = _rename(cat.snapshot(ECONOMIC, run), "ted", ["hyxl_dm", "hyml_dm"])
    df = _rename(cat.snapshot(ORG_PARAM, run), "df", ["jigouhao", "jigouzwm"])
    refund = cat.snapshot(REFUND, run)
    this_year = F.substring("repay_date", 1, 4) == F.lit(run.d8[:4])
    paid = (F.col("paid_int_amt") + F.col("paid_ovd_int_amt") + F.col("paid_ovd_prin_pnlt_amt")
            + F.col("paid_ovd_int_pnlt_amt"))
    c = refund.groupBy("credit_num").agg(F.sum(F.when(this_year, paid).otherwise(F.lit(0))).alias("bnlxsy"))
    ov = cat.snapshot(REPAY_PLAN, run).groupBy("credit_num").agg(F.count(F.lit(1)).alias("all_ovd_terms"))
    maps = cat.read(CODE_MAP).where(F.col("business_type") == MAP_BUSINESS_TYPE)

    j = (g.join(d, g.credit_num == d.d_credit_num, "left")
         .join(o, F.col("d_order_code") == o.o_order_code, "left")
         .join(e, F.col("o_order_seq") == e.e_order_seq, "left")
         .join(ted, F.col("e_industry_sub_code") == ted.ted_hyxl_dm, "left")
         .join(c, "credit_num", "left")
         .join(df, F.col("d_disb_bank_no") == df.df_jigouhao, "left")
         .join(subject_balances(cat, run), "credit_num", "left")
         .join(ov, "credit_num", "left"))
    j = code_map(j, "d_green_loan_purpose", maps, GREEN_TYPE_DICT, "m2_new_values")
    j = code_map(j, "d_yj_green_loan_purpose", maps, GREEN_PURPOSE_DICT, "m1_new_values")
    return j.select(*[expr.alias(name) for name, expr in _columns(run).items()])


def _columns(run: RunDate) -> dict[str, Column]:
    sts = F.col("status")
    ovd, clear = sts == OVERDUE, sts == CLEARED
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    rate_c = F.when(F.col("rate_type") == "F", "C").otherwise("Z99")
    prin_days, int_days = F.col("prin_ovd_days"), F.col("int_ovd_days")
    no_overdue_date = (sts == NORMAL) & (F.col("ovd_date").isNull() | (F.col("ovd_date") == "null"))
    green = F.col("d_is_green_loan") == "Y"
    next_repay = norm_date("next_repay_date")
    cols: dict[str, Column] = {
        "acct_num": F.col("d_contract_code"),
        "acct_sts": decode(sts, ACCT_STS, "9"),
        "acct_sts_desc": F.when(~sts.isin(*ACCT_STS), OTHER).otherwise(""),
        "accu_int_amt": (F.col("int_bal") + F.col("ovd_int_bal") + F.col("ovd_prin_pnlt_bal")
                         + F.col("ovd_int_pnlt_bal")),
        "actual_maturity_dt": norm_date("clear_date"),
        "base_int_rat": F.col("d_base_rate"),
        "cancel_flg": F.when(clear, "Y").otherwise("N"),
        "consecute_term_num": z("ovd_terms"),
        "cumulate_term_num": z("all_ovd_terms"),
        "current_term_num": z("current_terms"),
        "cust_id": F.col("cust_no"),
        "drawdown_amt": z("encash_amt"),
        "drawdown_base_int_rat": F.col("d_base_rate"),
        "drawdown_dt": norm_date("encash_date"),
        "drawdown_real_int_rat": F.col("year_rate") * 100,
        "emp_id": F.col("o_customer_manager_number"),
        "finish_dt": norm_date("clear_date"),
        "float_type": rate_c,
        "green_balance": F.when(green & clear, F.lit(0)).when(green & (sts != CLEARED),
                                                              z("prin_bal") + z("ovd_prin_bal")),
        "green_loan_flg": F.coalesce(F.col("d_is_green_loan"), F.lit("N")),
        "green_loan_type": F.col("m2_new_values"),
        "green_purpose_cd": F.col("m1_new_values"),
        "independence_pay_amt": z("encash_amt"),
        "i_od_dt": F.when(ovd, norm_date("ovd_date")),
        "loan_acct_bal": F.when(clear, F.lit(0)).otherwise(z("prin_bal") + z("ovd_prin_bal")),
        "loan_acct_bank": F.coalesce("df_jigouzwm", "d_disb_bank_name"),
        "loan_acct_name": F.col("d_disb_acct_name"),
        "loan_acct_num": F.col("d_disb_acct"),
        "loan_fhz_num": F.col("d_contract_code"),
        "loan_grade_cd": F.trim(F.coalesce(F.col("asset_class"), F.lit("1"))),
        "loan_num": F.col("credit_num"),
        "loan_purpose_area": F.col("o_region_code"),
        "loan_purpose_cd": F.concat(F.col("ted_hyml_dm"), F.col("ted_hyxl_dm")),   # NULL-propagating code
        "maturity_dt": norm_date("end_date"),
        "year_int_incom": F.col("bnlxsy"),
        "next_int_pay_dt": F.when(sts.isin(OVERDUE, CLEARED) & (next_repay <= F.lit(run.d)),
                                  F.lit(None).cast("date")).otherwise(next_repay),
        "next_repricing_dt": norm_date("end_date"),
        "od_days": F.when(ovd & (prin_days >= int_days), prin_days).when(ovd & (prin_days < int_days), int_days)
                    .otherwise(F.lit(0)),
        "od_flg": F.when(ovd, "Y").otherwise("N"),
        "od_int": F.when(no_overdue_date, F.lit(0)).otherwise(z("i1_sub_bal")),
        "od_int_obs": F.when(no_overdue_date, F.lit(0)).otherwise(z("i2_sub_bal")),
        "od_loan_acct_bal": F.col("ovd_prin_bal"),
        "org_num": F.col("org_num"),
        "orig_term": z("total_terms"),
        "pay_acct_bank": F.col("d_disb_bank_name"),
        "pay_acct_num": F.col("repay_acct_no"),
        "pricing_base_type": F.trim(rate_c),
        "p_od_dt": F.when(ovd & (F.col("ovd_prin_bal") > 0), norm_date("ovd_date")),
        "real_int_rat": F.col("year_rate") * 100,
        "repay_term_num": z("total_terms"),
        "od_type_js": F.when(ovd, F.when((F.col("ovd_prin_bal") > 0) & (F.col("ovd_int_bal") > 0), "03")
                             .when(F.col("ovd_prin_bal") > 0, "01").otherwise("02")).otherwise(""),
    }
    for name, value in CONSTANTS.items():
        cols[name] = F.lit(value)
    return cols
