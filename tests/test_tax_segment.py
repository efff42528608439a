"""WBYXNL_4 (tax-based loans) on hand-built source tables."""

import datetime as dt
from decimal import Decimal as d

from lendgrid.rundate import RunDate
from lendgrid.segments import Catalog, tax_loans
from lendgrid.segments.tax import GREEN_PURPOSE_DICT, GREEN_TYPE_DICT

RUN = RunDate(dt.date(2024, 1, 31))
B, O, P = dt.date(2024, 1, 1), dt.date(9999, 12, 31), "202401"
H = "begndt date, overdt date, partid string"


def hist(spark, rows, schema):
    return spark.createDataFrame([(*r, B, O, P) for r in rows], schema + ", " + H)


def build_frames(spark):
    g_s = ("credit_num string, status string, int_bal decimal(20,2), ovd_int_bal decimal(20,2), "
           "ovd_prin_pnlt_bal decimal(20,2), ovd_int_pnlt_bal decimal(20,2), clear_date string, ovd_terms int, "
           "current_terms int, cust_no string, encash_amt decimal(20,2), encash_date string, "
           "year_rate decimal(12,6), rate_type string, prin_bal decimal(20,2), ovd_prin_bal decimal(20,2), "
           "ovd_date string, asset_class string, end_date string, next_repay_date string, prin_ovd_days int, "
           "int_ovd_days int, org_num string, total_terms int, repay_acct_no string")
    one = d("1")
    g = [
        ("T1", "OVD", one, d("2"), d("3"), d("4"), None, 2, 5, "K1", d("1000"), "2023-05-01", d("0.0435"), "F",
         d("800"), d("100"), "20231220", None, "2024-05-01", "2024-01-20", 42, 50, "G1", 12, "R1"),
        ("T2", "NOR", one, one, one, one, None, None, 3, "K2", d("500"), "2023-06-01", d("0.05"), "L",
         d("500"), None, "null", "2", "2024-06-01", "2024-02-20", None, None, "G1", None, "R2"),
        ("T3", "CLEAR", one, one, one, None, "2024-01-10", 0, 12, "K3", d("200"), "2023-01-10", d("0.05"), "F",
         d("0"), d("0"), None, None, "2024-01-10", "2024-01-10", 0, 0, "G2", 12, "R3"),
        ("T4", "XXX", None, None, None, None, None, None, None, "K4", None, None, None, None,
         None, None, None, None, None, None, None, None, None, None, None),
    ]
    g_rows = [(*r, B, O, P) for r in g] + [(*g[0][:1], "NOR", *g[0][2:], B, RUN.d, P)]   # expired copy
    frames = {
        "OMI.WBYXNL_G_DLYH_LOAN_DETAIL_HS": spark.createDataFrame(g_rows, g_s + ", " + H),
        "OMI.WBYXNL_BUSI_DISB_APPLY_HS": hist(spark, [
            ("T1", "CT1", d("3.45"), "N", "BankA", "NameA", "ACC1", "OC1", "BN1", "GP1", "YJ1"),
            ("T2", "CT2", None, "Y", "BankB", "NameB", "ACC2", None, "BN9", "GP2", None),
            ("T3", "CT3", None, "Y", None, None, None, None, None, None, None)],
            "credit_num string, contract_code string, base_rate decimal(12,6), is_green_loan string, "
            "disb_bank_name string, disb_acct_name string, disb_acct string, order_code string, "
            "disb_bank_no string, green_loan_purpose string, yj_green_loan_purpose string"),
        "OMI.WBYXNL_BUSI_ORDER_INFO_HS": hist(spark, [("OC1", "OS1", "EMP1", "R01")],
                                              "order_code string, order_seq string, customer_manager_number string, "
                                              "region_code string"),
        "OMI.WBYXNL_BUSI_ORDER_EXTEND_HS": hist(spark, [("OS1", "C13")], "order_seq string, industry_sub_code string"),
        "OMI.WBYXNL_TD_ECONOMIC_INFO_HS": hist(spark, [("C13", "C")], "hyxl_dm string, hyml_dm string"),
        "OMI.WBYXNL_G_DLYH_REFUND_DETAIL_HS": hist(spark, [
            ("T1", "2024-01-05", one, d("2"), d("3"), d("4")), ("T1", "2023-12-01", d("5"), d("5"), d("5"), d("5"))],
            "credit_num string, repay_date string, paid_int_amt decimal(20,2), paid_ovd_int_amt decimal(20,2), "
            "paid_ovd_prin_pnlt_amt decimal(20,2), paid_ovd_int_pnlt_amt decimal(20,2)"),
        "OMI.KN_KBRP_JGCSHU_HS": hist(spark, [("BN1", "BranchOne")], "jigouhao string, jigouzwm string"),
        "OMI.WBYXNL_AMS_L_IOU_BAL_HS": hist(spark, [
            ("T1", "12010132", 3, d("7")), ("T1", "12010132", 3, d("1")), ("T1", "721102", 3, d("5")),
            ("T1", "12010132", 2, d("100"))],
            "disb_no string, sub_code string, sub_code_order int, sub_bal decimal(20,2)"),
        "OMI.WBYXNL_G_DLYH_REPAY_PLAN_HS": hist(spark, [("T1", 1), ("T1", 2), ("T1", 3)],
                                                "credit_num string, all_ovd_terms int"),
        "M_DICT_REMAPPING_DL": spark.createDataFrame([
            ("RSUM", GREEN_TYPE_DICT, "GP1", "GT-A"), ("RSUM", GREEN_PURPOSE_DICT, "YJ1", "GPC-A"),
            ("OTHER", GREEN_TYPE_DICT, "GP2", "x")],
            "business_type string, dict_code string, ori_values string, new_values string"),
    }
    return frames


def test_tax_segment_rows(spark):
    frames = build_frames(spark)
    rows = {r.loan_num: r for r in tax_loans(Catalog.frames(frames), RUN).collect()}
    assert set(rows) == {"T1", "T2", "T3", "T4"}
    t1, t2, t3, t4 = rows["T1"], rows["T2"], rows["T3"], rows["T4"]
    assert (t1.acct_sts, t2.acct_sts, t3.acct_sts, t4.acct_sts) == ("2", "1", "3", "9")
    assert (t1.acct_sts_desc, t4.acct_sts_desc) == ("", "其他")
    assert t1.accu_int_amt == d("10") and t3.accu_int_amt is None
    assert (t1.consecute_term_num, t1.cumulate_term_num, t1.current_term_num) == (2, 3, 5)
    assert (t2.consecute_term_num, t2.cumulate_term_num) == (0, 0)
    assert t1.drawdown_dt == dt.date(2023, 5, 1) and t1.real_int_rat == d("4.35")
    assert (t1.emp_id, t1.loan_purpose_area, t1.loan_purpose_cd) == ("EMP1", "R01", "CC13")
    assert (t1.float_type, t2.float_type, t2.pricing_base_type) == ("C", "Z99", "Z99")
    assert (t1.green_balance, t2.green_balance, t3.green_balance) == (None, d("500"), 0)
    assert (t1.green_loan_flg, t2.green_loan_flg, t4.green_loan_flg) == ("N", "Y", "N")
    assert (t1.green_loan_type, t1.green_purpose_cd, t2.green_loan_type) == ("GT-A", "GPC-A", None)
    assert t1.i_od_dt == dt.date(2023, 12, 20) and t1.p_od_dt == dt.date(2023, 12, 20) and t2.i_od_dt is None
    assert (t1.loan_acct_bal, t3.loan_acct_bal) == (d("900"), 0)
    assert (t1.loan_acct_bank, t2.loan_acct_bank) == ("BranchOne", "BankB")
    assert (t1.next_int_pay_dt, t2.next_int_pay_dt) == (None, dt.date(2024, 2, 20))
    assert (t1.od_days, t2.od_days, t3.od_days) == (50, 0, 0)
    assert (t1.od_int, t1.od_int_obs, t2.od_int) == (d("8"), d("5"), 0)
    assert (t1.od_type_js, t2.od_type_js) == ("03", "")
    assert (t1.loan_grade_cd, t2.loan_grade_cd) == ("1", "2")
    assert t1.year_int_incom == d("10") and t2.year_int_incom is None
    assert (t3.cancel_flg, t1.cancel_flg, t3.finish_dt) == ("Y", "N", dt.date(2024, 1, 10))
    assert (t1.orig_term, t2.orig_term) == (12, 0)
    assert t1.acct_typ_desc == "税闪贷" and t1.useofunds == "生产经营" and t1.tax_related_flg == "Y"
