"""BS_5 (discounted bills) on hand-built source tables."""

import datetime as dt
from decimal import Decimal as d

from lendgrid.rundate import RunDate
from lendgrid.segments import Catalog, bill_loans
from lendgrid.segments.bills import GREEN_TYPE_DICT

RUN = RunDate(dt.date(2024, 1, 31))
B, O, P = dt.date(2024, 1, 1), dt.date(9999, 12, 31), "202401"
H = "begndt date, overdt date, partid string"


def hist(spark, rows, schema):
    return spark.createDataFrame([(*r, B, O, P) for r in rows], schema + ", " + H)


def build_frames(spark):
    bdv_s = ("id string, contract_id string, account_status string, warrant_no string, payment_date string, "
             "maturity_date string, draft_type string, interest decimal(20,2), mix_flag string, draft_number string, "
             "org_cd_range string, pay_amount decimal(20,2), rate decimal(12,6), payment_days int, "
             "draft_amount decimal(20,2), aoa_bank_id string, aoa_account string, acceptor_bank_name string")
    bdv = [
        ("D1", "C1", "03", "W1", "20240120", "20240120", "1", d("5"), "0", "DN1", "0", d("995"), d("2.5"), 180,
         d("1000"), "BK1", "AC1", "Acceptor"),
        ("D2", "C1", "03", "W2", "20240601", "20240601", "2", d("9"), "1", "DN2", None, d("1990"), d("3"), 90,
         d("2000"), "BK2", "AC2", None),
        ("D3", "C1", "03", "W3", "20240301", "20240301", "1", d("1"), "1", "DN3", None, d("99"), d("2.2"), 60,
         d("100"), "BK1", "AC3", None),
        ("D4", "C1", "01", "W4", "20240301", "20240301", "1", None, "1", "DN4", None, None, None, None,
         None, None, None, None),
        ("D5", "C1", "03", "W5", "20240301", "20240301", "1", None, "1", "DN5", None, None, None, None,
         None, None, None, None),
    ]
    acc_s = "detail_id string, status string, end_dt string, update_time timestamp, sale_contract_id string, start_dt string"
    ts = dt.datetime(2024, 1, 10, 10, 0)
    frames = {
        "OMI.BS_BUY_DETAILS_VIEW_HS": hist(spark, bdv, bdv_s),
        "OMI.BS_BUY_CONTRACT_VIEW_HS": hist(spark, [("C1", "03", "CR1", "CU1", "Name1", "fastdis", "BB1")],
                                            "id string, account_status string, credit_no string, cust_no string, "
                                            "cust_name string, operator_no string, busi_branch_no string"),
        "OMI.BS_BMS_TRADE_DRAFT_HS": hist(spark, [("C1", "D1", "1", "20231201"), ("C1", "D2", "1", "20231215"),
                                                  ("C1", "D3", "1", "20231101"), ("C1", "D4", "1", "20231101")],
                                          "contract_id string, detail_id string, status string, acct_date string"),
        "OMI.BS_BMS_ACCT_HISTORY_HS": hist(spark, [
            ("D1", "1", None, ts, None, "20231201"), ("D2", "1", None, ts, None, "20231215"),
            ("D3", "2", None, ts, "Q1", "20231101"), ("D4", "1", None, ts, None, "20231101")], acc_s),
        "OMI.BS_MEM_BRH_INFO_HS": hist(spark, [("BK1", "X1", "ST01", "Bank One Full"), ("ZZ", "BK2", "ST01", "Bank Two Full")],
                                       "ubank_no string, brh_no string, brh_status string, brh_zh_full_name string"),
        "OMI.BS_CPES_QUOTE_CONTRACT_HS": hist(spark, [("Q1", d("0.021"))], "id string, rate decimal(12,6)"),
        "OMI.CL_BUSINESS_DUEBILL_HS": hist(spark, [
            ("W1", "K1", d("1000"), 0, "2024/01/20", "2023/12/01"), ("W2", "K2", d("2000"), 1, "2024/06/01", "2023/12/15")],
            "serialno string, relativeserialno2 string, balance decimal(20,2), extendtimes int, maturity string, "
            "putoutdate string"),
        "OMI.CL_BUSINESS_CONTRACT_HS": hist(spark, [
            ("K1", "MGR1", "G1", "A8610xx", "02", "02010", "N", "Working capital", None),
            ("K2", "MGR2", "0", "B1234", None, "005", "Y", None, 6)],
            "serialno string, manageuserid string, greenloanpurpose string, direction string, classifyresult string, "
            "vouchtype string, isftz string, purpose string, termmonth int"),
        "OMI.I9_ECL_FINAL_RESULT_HS": hist(spark, [("W1", d("12.34"))], "asset_no string, ecl_final decimal(20,2)"),
        "OMI.BS_BMS_CUSTOMER_INFO_HS": hist(spark, [("CU1", "0090102")], "cust_no string, bln_brh_no string"),
        "OMI.BS_BMS_CUST_ACCOUNT_INFO_HS": hist(spark, [("AC2", "Cust Bank")], "account_no string, acc_bank_name string"),
        "OMI.KN_KBRP_JGCSHU_HS": hist(spark, [("0090101", "420100"), ("0090102", "999999")],
                                      "jigouhao string, diqdaima string"),
        "OMI.CL_ADVANCED_INFO_HS": hist(spark, [("W1", "OLD1")], "duebillno string, oldduebillno string"),
        "M_DICT_REMAPPING_DL": spark.createDataFrame([("RSUM", GREEN_TYPE_DICT, "G1", "GLT1")],
                                                     "business_type string, dict_code string, ori_values string, "
                                                     "new_values string"),
    }
    return frames


def test_bill_segment_rows(spark):
    frames = build_frames(spark)
    rows = {r.loan_num: r for r in bill_loans(Catalog.frames(frames), RUN).collect()}
    assert set(rows) == {"W1", "W2", "W3"}
    w1, w2, w3 = rows["W1"], rows["W2"], rows["W3"]
    assert (w1.acct_sts, w2.acct_sts, w3.acct_sts) == ("2", "1", "3")
    assert (w1.acct_typ, w2.acct_typ, w1.item_cd, w2.item_cd) == ("030101", "030102", "11410601", "11410701")
    assert (w1.consecute_term_num, w1.cumulate_term_num, w2.consecute_term_num, w2.cumulate_term_num) == (1, 1, 0, 0)
    assert (w1.emp_id, w2.emp_id, w3.emp_id) == ("MGR1", "MGR2", None)
    assert (w1.draft_nbr, w2.draft_nbr) == ("DN1,0", "DN2")
    assert w1.drawdown_dt == dt.date(2023, 12, 1) and w1.sp_prov_amt == d("12.34") and w2.sp_prov_amt == 0
    assert (w1.green_balance, w1.green_loan_flg, w1.green_loan_type) == (d("1000"), "Y", "GLT1")
    assert (w2.green_balance, w2.green_loan_flg, w3.green_loan_flg) == (None, "N", "N")
    assert (w1.loans_to_culture_flag, w2.loans_to_culture_flag) == ("Y", "N")
    assert (w1.loan_acct_bal, w2.loan_acct_bal, w3.loan_acct_bal) == (d("1000"), d("2000"), 0)
    assert (w1.loan_acct_bank, w2.loan_acct_bank) == ("Bank One Full", "Bank Two Full")
    assert (w1.loan_grade_cd, w2.loan_grade_cd, w1.main_guaranty_typ, w2.main_guaranty_typ) == ("2", "1", "1", "3")
    assert (w1.od_days, w1.od_flg, w1.od_loan_acct_bal, w1.p_od_dt) == (11, "Y", d("1000"), dt.date(2024, 1, 20))
    assert (w2.od_days, w2.od_flg, w2.od_loan_acct_bal, w2.p_od_dt) == (0, "N", 0, None)
    assert (w1.real_int_rat, w3.real_int_rat, w3.loan_sell_int, w1.loan_sell_int) == (d("2.5"), d("2.1"), "Y", "N")
    assert (w1.orig_term, w1.orig_term_bc, w2.orig_term_bc, w3.orig_term_bc) == (50, 2, 6, None)
    assert (w1.loan_purpose_area, w1.orig_acct_no, w1.acct_sts_fhz, w1.acct_num_cqcs) == ("420100", "OLD1", "2", "K1")
    assert w3.finish_dt is None and w1.maturity_dt == dt.date(2024, 1, 20)
    assert w1.acct_num == "CR1" and w1.cust_id == "CU1" and w1.departmentd == "pjtx"
