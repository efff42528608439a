"""NL_3: online loans (one ledger row per active online loan).

Driving table: the online loan history, as of D, excluding failed
disbursements. Schedule, payment-log and account-mapping facts are
pre-aggregated per loan (one row per key) before being left-joined, so the
wide enrichment is a chain of keyed joins between frames that are unique on
the join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendgrid.functions import decode, norm_date
from lendgrid.operators import latest_by
from lendgrid.rundate import RunDate
from lendgrid.segments.catalog import Catalog

# Source table names.
LOAN = "OMI.NL_ACCT_LOAN_HS"
CONTRACT = "OMI.NL_BUSINESS_CONTRACT_CFS_HS"
ORG = "OMI.NL_ORG_INFO_CFS_HS"
CUSTOMER = "OMI.NL_CUSTOMER_INFO_CFS_HS"
PERSON = "OMI.KN_KCFB_CFDSJC_HS"
CODES = "OMI.NL_CODE_LIBRARY_CFS_HS"
RATE_SEG = "OMI.NL_ACCT_RATE_SEGMENT_HS"
REPAY_SEG = "OMI.NL_ACCT_RPT_SEGMENT_HS"
BUS_ACCT = "OMI.NL_ACCT_BUSINESS_ACCOUNT_HS"
SCHEDULE = "OMI.NL_ACCT_PAYMENT_SCHEDULE_HS"
PAY_LOG = "OMI.NL_ACCT_PAYMENT_LOG_HS"
ACCT_MAP = "OMI.KN_KDPA_ZHDUIZ_HS"

# Codes and labels of the online-loan system.
LOAN_OBJECT = "jbo.acct.ACCT_LOAN"
FAILED = "6"
OPEN_STATUSES = ("0", "1")
CLOSED_STATUSES = ("2", "3", "4", "9")
ACCT_STS = {"0": "1", "1": "2"}              # else '3' for 6,7,2,3,4,9; else '9'
ACCT_STS_CLOSED = ("6", "7", "2", "3", "4", "9")
KNOWN_STATUSES = ("0", "1", "2", "3", "4", "9")
OTHER = "其他"
BUSINESS_PRODUCT, CONSUMER_PRODUCT = "1010010", "1030010"
ACCT_TYP = {BUSINESS_PRODUCT: "010299", CONSUMER_PRODUCT: "010399"}
ACCT_TYP_DESC = {BUSINESS_PRODUCT: "个人经营性贷款", CONSUMER_PRODUCT: "个人消费性贷款"}
ACCT_TYP_DESC_OTHER = "互联网贷款"
ITEM_CD = {BUSINESS_PRODUCT: "11050201"}
ITEM_CD_OTHER = "11040401"
GENERALIZE = {BUSINESS_PRODUCT: "Y", CONSUMER_PRODUCT: "N"}
CONSUME_ADD_TYPE = {"4": "B", "5": "A"}
GRADE = {"正常": "1", "关注": "2", "次级": "3", "可疑": "4", "损失": "5"}
REPAY_TYP = {"RPT-01": "1", "RPT-04": "5", "RPT-03": "6"}
CLASSIFY_CODENO, PURPOSE_CODENO = "ClassifyResult", "CreditPurposeType"
RATE_TYPE_EXECUTED = "01"
PRICING_BASE_C = "090"
CONSTANTS = {
    "accu_int_flg": "Y", "book_type": "2", "campus_consu_loan_flg": "N", "cancel_flg": "N",
    "circle_loan_flg": "N", "comp_int_typ": "N", "curr_cd": "CNY", "departmentd": "xwdk",
    "drawdown_type": "A", "entrust_pay_amt": "0", "extendterm_flg": "N", "float_type": "C",
    "fund_use_loc_cd": "I", "gov_bondmorg_flg": "N", "green_loan_flg": "N", "guaranty_typ": "C99",
    "housmort_loan_typ": "N", "internet_loan_flg": "Y", "int_adjest_amt": 0, "int_rate_typ": "F",
    "int_repay_freq": "03", "is_first_report_loan_tag": "N", "is_repay_options": "Y",
    "loan_business_typ": "4", "loan_buy_int": "N", "loan_purpose_country": "CHN",
    "loan_purpose_country_new": "CHN", "loan_ratio": "100%", "loan_sell_int": "N", "low_risk_flag": "N",
    "main_guaranty_typ": "2", "od_int_obs": "0", "orig_term_type": "M", "oversea_ann_loan_flag": "N",
    "pftz_loan_flg": "N", "renew_flg": "N", "repay_flg": "N", "resched_flg": "N", "tax_related_flg": "N",
    "transfers_loan_flg": "N", "yangtze_river_loan_flg": "N",
}


def _by_object(df: DataFrame, *extra: Column) -> DataFrame:
    cond = F.col("objecttype") == LOAN_OBJECT
    for e in extra:
        cond = cond & e
    return df.where(cond)


def _rename(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def schedule_facts(cat: Catalog, run: RunDate, loans: DataFrame) -> DataFrame:
    """One row per loan from the repayment schedule: next pay date, earliest
    unpaid principal / interest dates, current period and the count of
    periods in arrears. All in one aggregate over the schedule."""
    d = F.lit(run.d)
    s = cat.snapshot(SCHEDULE, run).withColumn("pay_dt", norm_date("paydate"))
    # a period with an unknown amount is not due: the differences stay NULL, as in the source
    prcp_due = (F.col("payprincipalamt") - F.col("actualpayprincipalamt")) > 0
    int_due = (F.col("payinterestamt") - F.col("actualpayinterestamt") + F.col("payinterestpenaltyamt")
               - F.col("actualpayinterestpenaltyamt") + F.col("payprincipalpenaltyamt")
               - F.col("actualpayprincipalpenaltyamt")) > 0
    past = F.col("pay_dt") <= d
    future = F.col("pay_dt") >= d
    is_loan = F.col("relativeobjecttype") == LOAN_OBJECT
    sts = loans.select(F.col("serialno").alias("relativeobjectno"), "loanstatus", "overdueinterest")
    s = s.join(sts, "relativeobjectno", "left")
    open_loan = F.col("loanstatus").isin(*OPEN_STATUSES)
    closed_loan = F.col("loanstatus").isin(*CLOSED_STATUSES)
    arrears = (is_loan & F.col("loanstatus").isNotNull() & F.col("finishdate").isNull()
               & (past | (F.col("overdueinterest") > 0)))
    agg = s.groupBy("relativeobjectno").agg(
        F.min(F.when(future, F.col("pay_dt"))).alias("next_pay_dt"),
        F.min(F.when(past & prcp_due, F.col("pay_dt"))).alias("p_od_dt"),
        F.max(F.when(past & prcp_due, F.lit(1))).alias("has_p"),
        F.min(F.when(past & int_due, F.col("pay_dt"))).alias("i_od_dt"),
        F.max(F.when(past & int_due, F.lit(1))).alias("has_i"),
        F.max(F.when(is_loan & closed_loan, F.col("periodno"))).alias("last_period"),
        F.min(F.when(is_loan & open_loan & future, F.col("periodno"))).alias("next_period"),
        F.count(F.when(arrears, F.col("serialno"))).alias("arrears_ct"),
        F.max(F.when(arrears, F.lit(1))).alias("has_arrears"),
    )
    sentinel = F.lit(RunDate.parse("99991231").d)
    return agg.select(
        F.col("relativeobjectno").alias("serialno"), "next_pay_dt",
        # NVL(MIN(paydate), '99991231') of a group that exists
        F.when(F.col("has_p") == 1, F.coalesce("p_od_dt", sentinel)).alias("p_od_dt"),
        F.when(F.col("has_i") == 1, F.coalesce("i_od_dt", sentinel)).alias("i_od_dt"),
        "last_period", "next_period",
        F.when(F.col("has_arrears") == 1, F.col("arrears_ct")).alias("arrears_ct"))


def year_interest(cat: Catalog, run: RunDate) -> DataFrame:
    """Interest and penalties collected this calendar year, per loan."""
    log = cat.snapshot(PAY_LOG, run)
    this_year = F.substring("actualpaydate", 1, 4) == F.lit(run.d8[:4])
    amount = F.col("actualpayinterestamt") + F.col("actualpayprincipalpenaltyamt") + F.col("actualpayinterestpenaltyamt")
    return log.groupBy(F.col("relativeobjectno").alias("serialno")).agg(
        F.sum(F.when(this_year, amount).otherwise(F.lit(0))).alias("year_int_incom"))


def first_mapped_account(cat: Catalog, run: RunDate) -> DataFrame:
    """First mapped account number per customer account (by sequence)."""
    m = cat.snapshot(ACCT_MAP, run).select("kehuzhao", "zhanghao", "zhhaoxuh")
    return latest_by(m, ["kehuzhao"], [F.col("zhhaoxuh").asc(), F.col("zhanghao").asc()]).select(
        F.col("kehuzhao").alias("dz_kehuzhao"), F.col("zhanghao").alias("dz_zhanghao"))


def online_loans(cat: Catalog, run: RunDate) -> DataFrame:
    a = cat.snapshot(LOAN, run).where(F.col("loanstatus") != FAILED)
    d = _rename(cat.snapshot(CONTRACT, run), "d", ["serialno", "purposetype", "city", "direction", "businesstermmonth"])
    c = _rename(cat.snapshot(ORG, run), "c", ["orgid", "mainframeorgid"])
    b = _rename(cat.snapshot(CUSTOMER, run), "b", ["customerid", "mfcustomerid", "certid"])
    i = _rename(cat.snapshot(PERSON, run), "i", ["zhjhaoma", "kehuhaoo"])
    codes = cat.snapshot(CODES, run)
    e1 = _rename(codes.where(F.col("codeno") == CLASSIFY_CODENO), "e1", ["itemno", "itemname"])
    cl = _rename(codes.where(F.col("codeno") == PURPOSE_CODENO), "cl", ["itemno", "itemname"])
    f = _rename(_by_object(cat.snapshot(RATE_SEG, run), F.col("ratetype") == RATE_TYPE_EXECUTED), "f",
                ["objectno", "baserate", "businessrate", "baseratetype"])
    g = _rename(_by_object(cat.snapshot(REPAY_SEG, run)), "g", ["objectno", "termid"])
    h = _rename(_by_object(cat.snapshot(BUS_ACCT, run)), "h", ["objectno", "banksettlecode", "accountname", "accountno"])

    # grouped by join key: loan, then contract, org, customer, accounts, codes
    yi = year_interest(cat, run).withColumnRenamed("serialno", "yi_serialno")
    sf = schedule_facts(cat, run, a).withColumnRenamed("serialno", "sf_serialno")
    j = (a.join(f, a.serialno == f.f_objectno, "left")                            # keyed on the loan
         .join(g, a.serialno == g.g_objectno, "left")
         .join(h, a.serialno == h.h_objectno, "left")
         .join(yi, a.serialno == F.col("yi_serialno"), "left")
         .join(sf, a.serialno == F.col("sf_serialno"), "left")
         .join(d, a.contractserialno == d.d_serialno, "left")                     # the contract
         .join(cl, F.col("d_purposetype") == cl.cl_itemno, "left")
         .join(c, a.accountingorgid == c.c_orgid, "left")                         # the org
         .join(b, a.customerid == b.b_customerid, "left")                         # the customer
         .join(i, F.col("b_certid") == i.i_zhjhaoma, "left")
         .join(first_mapped_account(cat, run), F.col("h_accountno") == F.col("dz_kehuzhao"), "left")
         .join(e1, a.classifyresult == e1.e1_itemno, "left"))
    return j.select(*[expr.alias(name) for name, expr in _columns().items()])


def _columns() -> dict[str, Column]:
    sts = F.col("loanstatus")
    product = F.col("productid")
    ct = F.col("arrears_ct")
    consecutive = F.coalesce(F.when(sts == "1", ct), F.lit(0))
    cumulative = F.coalesce(F.when(sts != FAILED, ct), F.lit(0))
    end_or_maturity = norm_date(F.coalesce(F.col("finishdate"), F.col("maturitydate")))
    termid = F.col("g_termid")
    cols: dict[str, Column] = {
        "acct_num": F.col("d_serialno"),
        "acct_sts": decode(sts, ACCT_STS).otherwise(
            F.when(sts.isin(*ACCT_STS_CLOSED), "3").otherwise("9")),
        "acct_sts_desc": F.when(~sts.isin(*KNOWN_STATUSES), OTHER),
        "acct_typ": F.when(product == BUSINESS_PRODUCT, ACCT_TYP[BUSINESS_PRODUCT]).otherwise(ACCT_TYP[CONSUMER_PRODUCT]),
        "acct_typ_desc": decode(product, ACCT_TYP_DESC, ACCT_TYP_DESC_OTHER),
        "accu_int_amt": F.col("accruedinterest"),
        "actual_maturity_dt": end_or_maturity,
        "base_int_rat": F.col("f_baserate"),
        "consecute_term_num": consecutive,
        "consume_loan_add_type": decode("d_purposetype", CONSUME_ADD_TYPE, ""),
        "cumulate_term_num": F.greatest(consecutive, cumulative),
        "current_term_num": F.coalesce("last_period", "next_period", F.lit(0)),
        "cust_id": F.coalesce("i_kehuhaoo", "b_mfcustomerid", "customerid"),
        "drawdown_amt": F.coalesce(F.col("businesssum"), F.lit(0)),
        "drawdown_base_int_rat": F.col("f_baserate"),
        "drawdown_dt": norm_date("putoutdate"),
        "drawdown_real_int_rat": F.coalesce(F.col("f_businessrate"), F.lit(0)),
        "finish_dt": norm_date("finishdate"),
        "generalize_loan_flg": decode(product, GENERALIZE),
        "independence_pay_amt": F.coalesce(F.col("businesssum"), F.lit(0)),
        "item_cd": decode(product, ITEM_CD, ITEM_CD_OTHER),
        "i_od_dt": F.col("i_od_dt"),
        "loan_acct_bal": F.when(sts.isin(*CLOSED_STATUSES), F.lit(0)).otherwise(
            F.coalesce(F.col("normalbalance"), F.lit(0)) + F.coalesce(F.col("overduebalance"), F.lit(0))),
        "loan_acct_bank": F.col("h_banksettlecode"),
        "loan_acct_name": F.col("h_accountname"),
        "loan_acct_num": F.coalesce("dz_zhanghao", "h_accountno"),
        "loan_fhz_num": F.col("serialno"),
        "loan_grade_cd": F.trim(F.when(F.col("e1_itemname").isNull(), "1").otherwise(decode("e1_itemname", GRADE))),
        "loan_num": F.col("serialno"),
        "loan_purpose_area": F.col("d_city"),
        "loan_purpose_cd": F.col("d_direction"),
        "maturity_dt": norm_date("originalmaturitydate"),
        "year_int_incom": F.col("year_int_incom"),
        "next_int_pay_dt": F.col("next_pay_dt"),
        "next_repricing_dt": end_or_maturity,
        "od_days": F.col("overduedays"),
        "od_flg": F.when(sts == "1", "Y").otherwise("N"),
        "od_int": F.col("overdueinterest"),
        "od_loan_acct_bal": F.col("overduebalance"),
        "org_num": F.col("c_mainframeorgid"),
        "orig_term": F.col("d_businesstermmonth"),
        "pay_acct_bank": F.col("h_banksettlecode"),
        "pay_acct_num": F.coalesce("dz_zhanghao", "h_accountno"),
        "pricing_base_type": F.trim(F.when(F.col("f_baseratetype") == PRICING_BASE_C, "C").otherwise("Z99")),
        "p_od_dt": F.col("p_od_dt"),
        "real_int_rat": F.coalesce(F.col("f_businessrate"), F.lit(0)),
        "repay_term_num": F.col("d_businesstermmonth"),
        "repay_typ": decode(termid, REPAY_TYP, "7"),
        # NOT IN with a NULL code is not true, so NULL gets ''
        "repay_typ_desc": F.when(~termid.isin(*REPAY_TYP), OTHER).otherwise(""),
        "useofunds": F.col("cl_itemname"),
    }
    for name, value in CONSTANTS.items():
        cols[name] = F.lit(value)
    return cols
