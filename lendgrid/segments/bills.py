"""BS_5: discounted bills (one ledger row per bought bill).

Driving set: bought-bill details inner-joined to their batch, their booked
trade draft and their balance row (all as of D, booked status only). The
credit-system duebill/contract, branch registries, customer accounts,
provisions and the sale quote are left-joined on their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendgrid.functions import decode, norm_date, term_months
from lendgrid.operators import code_map
from lendgrid.rundate import RunDate
from lendgrid.segments.catalog import Catalog
from lendgrid.segments.codes import CULTURE_INDUSTRIES
from lendgrid.sources import date_window

# Source table names.
DETAILS = "OMI.BS_BUY_DETAILS_VIEW_HS"
BATCH = "OMI.BS_BUY_CONTRACT_VIEW_HS"
DRAFT = "OMI.BS_BMS_TRADE_DRAFT_HS"
BALANCE = "OMI.BS_BMS_ACCT_HISTORY_HS"
BRANCH = "OMI.BS_MEM_BRH_INFO_HS"
QUOTE = "OMI.BS_CPES_QUOTE_CONTRACT_HS"
DUEBILL = "OMI.CL_BUSINESS_DUEBILL_HS"
CONTRACT = "OMI.CL_BUSINESS_CONTRACT_HS"
PROVISION = "OMI.I9_ECL_FINAL_RESULT_HS"
BILL_CUSTOMER = "OMI.BS_BMS_CUSTOMER_INFO_HS"
CUST_ACCOUNT = "OMI.BS_BMS_CUST_ACCOUNT_INFO_HS"
ORG_PARAM = "OMI.KN_KBRP_JGCSHU_HS"
ADVANCED = "OMI.CL_ADVANCED_INFO_HS"
CODE_MAP = "M_DICT_REMAPPING_DL"

# Statuses, codes and labels of the bill system.
BOOKED = "03"
DRAFT_ACTIVE = "1"
OPEN, SETTLED = "1", "2"
ACTIVE_BRANCH = "ST01"
FAST_OPERATOR = "FASTDIS"
ORG_REWRITE = {"0090102": "0090101"}
GREEN_TYPE_DICT = "CL-GREENLOANPURPOSE-GREEN_LOAN_TYPE"
MAP_BUSINESS_TYPE = "RSUM"
GRADE = {"01": "1", "02": "2", "03": "3", "04": "4", "05": "5"}
ITEM_CD = {"1": "11410601"}
ITEM_CD_OTHER = "11410701"
CONSTANTS = {
    "accu_int_amt": 0, "accu_int_flg": "Y", "book_type": "2", "campus_consu_loan_flg": "N", "cancel_flg": "N",
    "circle_loan_flg": "N", "current_term_num": 1, "curr_cd": "CNY", "departmentd": "pjtx", "drawdown_type": "A",
    "extendterm_flg": "N", "fund_use_loc_cd": "I", "generalize_loan_flg": "N", "gov_bondmorg_flg": "N",
    "housmort_loan_typ": "N", "indust_tran_flg": "2", "internet_loan_flg": "N", "int_adjest_amt": 0,
    "int_rate_typ": "F", "int_repay_freq": "99", "int_repay_freq_desc": "期初一次性扣除利息",
    "is_repay_options": "Y", "loan_business_typ": "9", "loan_buy_int": "N", "loan_purpose_country_new": "CHN",
    "low_risk_flag": "N", "od_int": 0, "od_int_obs": 0, "oversea_ann_loan_flag": "N", "poverty_alle": "N",
    "ppl_repay_freq": "07", "pricing_base_type": "Z99", "renew_flg": "N", "repay_flg": "N",
    "repay_term_num": 1, "repay_typ": "7", "repay_typ_desc": "承兑、贴现或者保证人到期付款", "resched_flg": "N",
    "tax_related_flg": "N", "transfers_loan_flg": "N", "yangtze_river_loan_flg": "N", "guaranty_typ": "D",
    "orig_term_type": "D",
}


def _rename(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def bill_loans(cat: Catalog, run: RunDate) -> DataFrame:
    bdv = cat.snapshot(DETAILS, run).where(F.col("account_status") == BOOKED)
    bcv = _rename(cat.snapshot(BATCH, run).where(F.col("account_status") == BOOKED), "bcv",
                  ["id", "credit_no", "cust_no", "cust_name", "operator_no", "busi_branch_no"])
    btd = _rename(cat.snapshot(DRAFT, run).where(F.col("status") == DRAFT_ACTIVE), "btd",
                  ["contract_id", "detail_id", "acct_date"])
    acc = _rename(date_window(cat.snapshot(BALANCE, run), "start_dt", None, run.d), "acc",
                  ["detail_id", "status", "end_dt", "update_time", "sale_contract_id"])
    branches = cat.snapshot(BRANCH, run)
    bank = _rename(branches, "bank", ["ubank_no", "brh_zh_full_name"])
    m2 = _rename(branches.where(F.col("brh_status") == ACTIVE_BRANCH), "m2", ["brh_no", "brh_zh_full_name"])
    cqc = _rename(cat.snapshot(QUOTE, run), "cqc", ["id", "rate"])
    bd = _rename(cat.snapshot(DUEBILL, run), "bd",
                 ["serialno", "relativeserialno2", "balance", "extendtimes", "maturity", "putoutdate"])
    bc = _rename(cat.snapshot(CONTRACT, run), "bc", [
        "serialno", "manageuserid", "greenloanpurpose", "direction", "classifyresult", "vouchtype", "isftz",
        "purpose", "termmonth"])
    i9 = _rename(cat.snapshot(PROVISION, run), "i9", ["asset_no", "ecl_final"])
    cust1 = _rename(cat.snapshot(BILL_CUSTOMER, run), "cust1", ["cust_no", "bln_brh_no"])
    cust = _rename(cat.snapshot(CUST_ACCOUNT, run), "cust", ["account_no", "acc_bank_name"])
    kj4 = _rename(cat.snapshot(ORG_PARAM, run), "kj4", ["jigouhao", "diqdaima"])
    ai = _rename(cat.snapshot(ADVANCED, run), "ai", ["duebillno", "oldduebillno"])
    maps = cat.read(CODE_MAP).where(F.col("business_type") == MAP_BUSINESS_TYPE)

    j = (bdv.join(bcv, bdv.contract_id == bcv.bcv_id)
         .join(btd, (btd.btd_contract_id == F.col("bcv_id")) & (btd.btd_detail_id == bdv.id))
         .join(acc, bdv.id == acc.acc_detail_id)
         .join(bank, bank.bank_ubank_no == bdv.aoa_bank_id, "left")
         .join(cqc, cqc.cqc_id == F.col("acc_sale_contract_id"), "left")
         .join(m2, m2.m2_brh_no == bdv.aoa_bank_id, "left")
         .join(bd, bdv.warrant_no == bd.bd_serialno, "left")
         .join(bc, F.col("bd_relativeserialno2") == bc.bc_serialno, "left")
         .join(i9, bdv.warrant_no == i9.i9_asset_no, "left")
         .join(cust1, F.col("bcv_cust_no") == cust1.cust1_cust_no, "left")
         .join(cust, cust.cust_account_no == bdv.aoa_account, "left")
         .join(kj4, decode("cust1_bln_brh_no", ORG_REWRITE, F.col("cust1_bln_brh_no")) == kj4.kj4_jigouhao, "left")
         .join(ai, ai.ai_duebillno == F.col("bd_serialno"), "left"))
    j = code_map(j, "bc_greenloanpurpose", maps, GREEN_TYPE_DICT, "m_new_values")
    return j.select(*[expr.alias(name) for name, expr in _columns(run).items()])


def _columns(run: RunDate) -> dict[str, Column]:
    d = F.lit(run.d)
    sts = F.col("acc_status")
    pay_dt = norm_date("payment_date")
    maturity = norm_date("maturity_date")
    overdue = (sts == OPEN) & (pay_dt <= d)
    acct_sts = F.when(overdue, "2").otherwise(decode(sts, {SETTLED: "3"}, "1"))
    # NVL(end_dt, update day): the end date when present, else the update day
    closed_on = F.when(F.col("acc_end_dt").isNotNull(), norm_date("acc_end_dt")).otherwise(F.to_date("acc_update_time"))
    sold = (sts == SETTLED) & (closed_on < maturity)
    green = F.coalesce(F.col("bc_greenloanpurpose"), F.lit("0")) != "0"
    vouch = F.col("bc_vouchtype")
    vouch3 = F.substring(vouch, 1, 3)
    extended_term = term_months(norm_date("bd_putoutdate"), norm_date("bd_maturity"))
    cols: dict[str, Column] = {
        "acct_num": F.col("bcv_credit_no"),
        "acct_sts": acct_sts,
        "acct_typ": F.when(F.col("draft_type") == "1", "030101").otherwise("030102"),
        "actual_maturity_dt": maturity,
        "consecute_term_num": F.when(pay_dt <= d, F.lit(1)).otherwise(F.lit(0)),
        "cumulate_term_num": F.when(overdue, F.lit(1)).otherwise(F.lit(0)),
        "cust_id": F.col("bcv_cust_no"),
        "discount_interest": F.col("interest"),
        "draft_nbr": F.when(F.col("mix_flag") == "1", F.col("draft_number")).otherwise(
            F.concat(F.col("draft_number"), F.lit(","), F.col("org_cd_range"))),
        "drawdown_amt": F.col("pay_amount"),
        "drawdown_dt": norm_date("btd_acct_date"),
        "drawdown_real_int_rat": F.col("rate"),
        "emp_id": F.when(F.upper("bcv_operator_no") == FAST_OPERATOR, F.col("bc_manageuserid"))
                   .otherwise(F.col("bcv_operator_no")),
        "finish_dt": F.when(sts == SETTLED, norm_date("acc_end_dt")),
        "sp_prov_amt": F.coalesce(F.col("i9_ecl_final"), F.lit(0)),
        "green_balance": F.when(green, F.col("bd_balance")),
        "green_loan_flg": F.when(green, "Y").otherwise("N"),
        "green_loan_type": F.col("m_new_values"),
        "int_num_date": F.col("payment_days"),
        "item_cd": decode("draft_type", ITEM_CD, ITEM_CD_OTHER),
        "loans_to_culture_flag": F.when(F.substring("bc_direction", 2, 4).isin(*CULTURE_INDUSTRIES), "Y")
                                  .otherwise("N"),
        "loan_acct_bal": F.when(sts == SETTLED, F.lit(0)).otherwise(F.col("draft_amount")),
        "loan_acct_bank": F.coalesce("bank_brh_zh_full_name", "m2_brh_zh_full_name", "cust_acc_bank_name"),
        "loan_acct_name": F.col("bcv_cust_name"),
        "loan_acct_num": F.col("aoa_account"),
        "loan_fhz_num": F.col("warrant_no"),
        "loan_grade_cd": F.trim(decode("bc_classifyresult", GRADE, "1")),
        "loan_num": F.col("warrant_no"),
        "loan_purpose_area": F.col("kj4_diqdaima"),
        "loan_purpose_cd": F.col("bc_direction"),
        "main_guaranty_typ": (F.when(vouch3.isin("040", "050"), "0").when(vouch.like("020%"), "1")
                              .when(vouch3.isin("010", "070"), "2").when(vouch == "005", "3")),
        "maturity_dt": maturity,
        "next_int_pay_dt": maturity,
        "next_repricing_dt": maturity,
        "od_days": F.when(overdue, F.datediff(d, pay_dt)).otherwise(F.lit(0)),
        "od_flg": F.when(overdue, "Y").otherwise("N"),
        "od_loan_acct_bal": F.when(overdue, F.col("draft_amount")).otherwise(F.lit(0)),
        "org_num": F.col("bcv_busi_branch_no"),
        "orig_acct_no": F.col("ai_oldduebillno"),
        "pay_acct_bank": F.col("acceptor_bank_name"),
        "pftz_loan_flg": F.col("bc_isftz"),
        "p_od_dt": F.when(overdue, pay_dt),
        "real_int_rat": F.when(sold, F.col("cqc_rate") * 100).otherwise(F.col("rate")),
        "useofunds": F.col("bc_purpose"),
        "loan_sell_int": F.when(sold, "Y").otherwise("N"),
        "orig_term": F.datediff(maturity, norm_date("btd_acct_date")),
        "orig_term_bc": F.when(F.col("bd_extendtimes") != 0, F.coalesce(F.col("bc_termmonth"), extended_term))
                         .otherwise(extended_term),
        "acct_sts_fhz": acct_sts,
        "acct_num_cqcs": F.col("bc_serialno"),
    }
    for name, value in CONSTANTS.items():
        cols[name] = F.lit(value)
    return cols
