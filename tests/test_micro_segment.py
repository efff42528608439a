"""XL_6 (micro loans) on hand-built source tables."""

import datetime as dt
from decimal import Decimal as d

from lendgrid.rundate import RunDate
from lendgrid.segments import Catalog, micro_loans
from lendgrid.segments.micro import GREEN_PURPOSE_DICT

RUN = RunDate(dt.date(2024, 1, 31))
B, O, P = dt.date(2024, 1, 1), dt.date(9999, 12, 31), "202401"
H = "begndt date, overdt date, partid string"

VCH_COLS = [
    ("vchno", "string"), ("contno", "string"), ("applyno", "string"), ("cifid", "string"), ("bus_sum", "decimal(20,2)"),
    ("vch_sts", "string"), ("loan_sts", "string"), ("prdt_no", "string"), ("pay_type", "string"), ("occurtype", "string"),
    ("guar_type", "string"), ("float_mod", "string"), ("rate_ftype", "string"), ("term_type", "string"),
    ("repay_freq", "string"), ("clsfive", "string"), ("data_source", "string"), ("depacc_no", "string"),
    ("reppriac_no", "string"), ("core_prdt_no", "string"), ("bal_overday", "int"), ("int_overday", "int"),
    ("lo_date", "string"), ("ext_num", "int"), ("purpose", "string"), ("base_rate_type", "string"),
    ("extenddate", "string"), ("enddate", "string"), ("begindate", "string"), ("bus_bal", "decimal(20,2)"),
    ("brate", "decimal(12,6)"), ("irate", "decimal(12,6)"), ("arate", "decimal(12,6)"), ("curr", "string"),
    ("now_overdue_period", "int"), ("overdue_period", "int"), ("now_period", "int"), ("manage_operid", "string"),
    ("finishdate", "string"), ("next_pay_int_date", "string"), ("bal_instcode", "string"), ("org_vchno", "string"),
    ("term", "int"), ("period_all", "int"), ("repay_type", "string"), ("use_transfer_funds", "string"),
    ("depaccna", "string"),
]


def hist(spark, rows, schema):
    return spark.createDataFrame([(*r, B, O, P) for r in rows], schema + ", " + H)


def vouchers(spark):
    base = dict(vchno=None, contno=None, applyno=None, cifid=None, bus_sum=d("1000"), vch_sts="10", loan_sts="1",
                prdt_no="X", pay_type="1", occurtype="01", guar_type="50", float_mod="1", rate_ftype="0",
                term_type="M", repay_freq="1", clsfive="0102", data_source="X", depacc_no="DEP1", reppriac_no="REP1",
                core_prdt_no=None, bal_overday=0, int_overday=0, lo_date=None, ext_num=0, purpose="105",
                base_rate_type="0", extenddate=None, enddate="20250101", begindate="20230101", bus_bal=d("800"),
                brate=d("3.45"), irate=d("3.65"), arate=d("4.5"), curr="CNY", now_overdue_period=0,
                overdue_period=0, now_period=1, manage_operid="M1", finishdate=None, next_pay_int_date="20240215",
                bal_instcode="BI1", org_vchno=None, term=24, period_all=24, repay_type="1",
                use_transfer_funds="0", depaccna="DepName")
    v1 = dict(base, vchno="CON001", contno="K1", applyno="AP1", cifid="CF1", loan_sts="2", prdt_no="XA1",
              pay_type="2", guar_type="10", repay_freq="3", clsfive="0202", core_prdt_no="CP1", bal_overday=5,
              int_overday=9, lo_date="20240101", ext_num=1, repay_type="3", use_transfer_funds="1",
              now_overdue_period=2, overdue_period=3, now_period=5)
    v2 = dict(base, vchno="12345678901234567", contno="K2", applyno="AP2", cifid="CF2", loan_sts="*",
              prdt_no="B04X", pay_type=None, guar_type="10", data_source="LSXD", depacc_no=None, reppriac_no="REP2",
              purpose="18", base_rate_type="9", float_mod="0", rate_ftype="0", term_type="D")
    v3 = dict(base, vchno="CON003", bus_sum=d("0"))
    v4 = dict(base, vchno="CON004", vch_sts="20")
    rows = [tuple(v[c] for c, _ in VCH_COLS) for v in (v1, v2, v3, v4)]
    return hist(spark, rows, ", ".join(f"{c} {t}" for c, t in VCH_COLS))


def build_frames(spark):
    z = d("0")
    sched_s = ("vchno string, currcnt int, rependdate string, curramt decimal(20,2), paysum decimal(20,2), "
               "currint decimal(20,2), payint decimal(20,2), over_int decimal(20,2), pay_over_int decimal(20,2), "
               "lo_ind string, repaystate string")
    frames = {
        "OMI.XL_AC_BUSINESSVCH_HS": vouchers(spark),
        "OMI.XL_LN_MST_HS": hist(spark, [("CON001", "6", d("10"), None, d("3"), d("100"), "20240701")],
                                 "vchno string, ac_sts string, loss_bal decimal(20,2), in_lo_intst decimal(20,2), "
                                 "out_lo_intst decimal(20,2), over_bal decimal(20,2), next_rateadj_date string"),
        "OMI.XL_AC_BUSINESSCONT_HS": hist(spark, [("K1", "AP1", "10", None)],
                                          "contno string, applyno string, guar_type string, oth_guar_type string"),
        "OMI.XL_BUS_DATA_REPORT_HS": hist(spark, [("AP1", "0", "1", "S1", "1", "1", "1", "IND1", "01", "1", "G7")],
                                          "applyno string, school_loan_flag string, is_greloan_cbrc string, "
                                          "oc_prcp string, loan_target_field string, loan_target_field2 string, "
                                          "first_loan_own string, industrytype string, jzfp_cust_type string, "
                                          "startupguauantee_flag string, gre_industrytype_cbrc string"),
        "OMI.XL_APP_VCH_REL_HS": hist(spark, [("AP1", "200"), ("AP1", "1999"), ("AP1", "150")],
                                      "applyno string, vchno string"),
        "OMI.XL_AC_TEPAYMENT_HS": hist(spark, [("AP1", d("300")), ("AP1", d("200"))], "applyno string, bus_sum decimal(20,2)"),
        "OMI.XL_LN_SCHEDULE_HS": hist(spark, [
            ("CON001", 1, "20240115", d("100"), d("50"), d("10"), d("10"), z, z, "1", "0"),
            ("CON001", 2, "20240215", d("100"), z, d("12"), z, d("1"), z, "0", "0"),
            ("CON001", 0, "20231215", d("100"), d("100"), d("8"), z, z, z, "1", "0")], sched_s),
        "OMI.XL_AC_VERIFI_INFO_HS": hist(spark, [("12345678901234567", "20240110")], "vchno string, occur_date string"),
        "OMI.XL_CUST_INFO_HS": hist(spark, [("CF1", "OC1", "Cli1", "C01")],
                                    "cifid string, outcifid string, cliname string, cstype string"),
        "OMI.XL_ENT_BASE_HS": hist(spark, [("CF1", "R-ENT")], "cifid string, regioncode string"),
        "OMI.XL_IND_BASE_HS": hist(spark, [("CF1", "R-IND")], "cifid string, regioncode string"),
        "OMI.KN_KDPA_KEHUZH_HS": hist(spark, [("DEP1", "ORG1"), ("REP1", "ORG2")], "kehuzhao string, kaihjigo string"),
        "OMI.KN_KBRP_JGCSHU_HS": hist(spark, [("ORG1", "Org One", "D1"), ("ORG2", "Org Two", "D2"),
                                              ("ORG3", "Org Three", "D3")],
                                      "jigouhao string, jigouzwm string, diqdaima string"),
        "URDM.ACNO_INSTCODE_MAPPING": spark.createDataFrame([("REP2", "2", "ORG3"), ("REP2", "1", "ORG3")],
                                                            "acno string, acno_type string, instcode string"),
        "OMI.XL_CN_SOPTLIST_HS": hist(spark, [("loanPurpose", "105", "working capital")],
                                      "dccode string, ddcode string, ddvalue string"),
        "OMI.XL_DC_LOG_HS": hist(spark, [("CON001", "H1", "B", "20240105", d("7")), ("CON001", "H1", "B", "20231231", d("100")),
                                         ("CON001", "H2", "B", "20240110", d("50"))],
                                 "vchno string, acc_hrt string, bankid string, tx_date string, amt decimal(20,2)"),
        "OMI.XL_COM_ITEM_HS": hist(spark, [("H1", "B", "5001", "ACC-H1"), ("H2", "B", "9999", "ACC-H2")],
                                   "acc_hrt string, bankid string, up_acc_hrt string, acc_no string"),
        "OMI.XL_CN_SYSPARM_HS": hist(spark, [("0001", "E", "sysdate", "20240131"), ("0002", "E", "other", "19990101")],
                                     "parcode string, stcd string, parname string, parvalue string"),
        "OMI.XL_LN_INT_STATUS_HS": hist(spark, [("12345678901234567", "1")], "vchno string, status string"),
        "OMI.XL_LN_PARM_HS": hist(spark, [("DC1", "B", "CP1")], "dc_code string, bankid string, prdt_no string"),
        "OMI.XL_DC_ACC_REL_HS": hist(spark, [("DC1", "B", "H1", "1"), ("DC1", "B", "H2", "2")],
                                     "dc_code string, bankid string, acc_hrt string, dc_type string"),
        "OMI.XL_BUS_GCC_RELATIVE_HS": hist(spark, [("K1", "AP1", "GC1")], "contno string, applyno string, gccontno string"),
        "OMI.XL_AC_GUARCONT_HS": hist(spark, [("GC1", "10")], "contno string, guarform string"),
        "OMI.XL_BUS_AFFRIM_COLLATERAL_HS": hist(spark, [("AP1", "x", "G1"), ("AP1", "x", "G2")],
                                                "applyno string, cifid string, guar_no string"),
        "OMI.XL_GUAR_BASE_HS": hist(spark, [("G1", "030101"), ("G2", "0501xx")], "guar_no string, col_no string"),
        "M_DICT_REMAPPING_DL": spark.createDataFrame([("RSUM", GREEN_PURPOSE_DICT, "G7%", "GP7")],
                                                     "business_type string, dict_code string, ori_values string, "
                                                     "new_values string"),
    }
    return frames


def test_micro_segment_rows(spark):
    frames = build_frames(spark)
    out = micro_loans(Catalog.frames(frames), RUN).collect()
    rows = {r.loan_num: r for r in out}
    assert len(out) == 2 and set(rows) == {"CON001", "123456789012341"}
    v1, v2 = rows["CON001"], rows["123456789012341"]
    assert (v1.acct_sts, v2.acct_sts) == ("2", "3")
    assert (v1.acct_typ, v2.acct_typ) == ("010299", "0202")
    assert (v1.guaranty_typ, v2.guaranty_typ) == ("B99", "B01")
    assert (v1.guaranty_typ_js, v2.guaranty_typ_js) == ("B01", "E")       # multi-collateral collapsed to real estate
    assert (v1.accu_int_amt, v2.accu_int_amt) == (d("12"), 0)
    assert (v1.accu_int_flg, v2.accu_int_flg) == ("Y", "N")
    assert (v1.p_od_dt, v1.i_od_dt) == (dt.date(2024, 1, 15), dt.date(2023, 12, 15))
    assert (v1.drawdown_type, v2.drawdown_type, v2.drawdown_type_desc) == ("B", "Z", "历史早期贷款")
    assert (v1.entrust_pay_amt, v1.independence_pay_amt) == (d("500"), 0)
    assert (v1.extendterm_flg, v1.cancel_flg, v2.cancel_flg) == ("Y", "Y", "N")
    assert (v1.int_rate_typ, v2.int_rate_typ) == ("F", "L0")
    assert (v1.int_repay_freq, v2.int_repay_freq, v1.ppl_repay_freq) == ("04", "03", "04")
    assert (v1.item_cd, v2.item_cd) == ("ACC-H1", None)
    assert (v1.loan_acct_num, v2.loan_acct_num) == ("DEP1", "REP2")
    assert (v1.loan_acct_bank, v2.loan_acct_bank, v1.pay_acct_bank, v2.pay_acct_bank) == (
        "Org One", "Org Three", "Org Two", "Org Three")
    assert (v1.loan_purpose_area, v2.loan_purpose_area) == ("R-ENT", "D3")
    assert (v1.loan_acct_name, v2.loan_acct_name, v1.cust_id, v2.cust_id) == ("Cli1", "DepName", "OC1", "CF2")
    assert v1.loan_num_old == "1501|19991|200" and v2.loan_num_old is None
    assert (v1.green_balance, v1.green_loan_flg, v1.green_purpose_cd, v2.green_balance) == (d("800"), "Y", "GP7", 0)
    assert (v1.od_days, v2.od_days, v1.od_flg, v2.od_flg) == (9, 0, "Y", "N")
    assert (v1.od_int, v1.od_int_obs, v1.od_loan_acct_bal) == (0, d("3"), d("100"))
    assert (v1.mon_int_incom, v2.mon_int_incom) == (d("7"), None)
    assert (v1.next_repricing_dt, v2.next_repricing_dt) == (dt.date(2024, 7, 1), dt.date(2025, 1, 1))
    assert (v1.finish_dt, v2.finish_dt) == (None, dt.date(2024, 1, 10))
    assert (v1.pricing_base_type, v2.pricing_base_type, v1.float_type) == ("C", "", "A")
    assert (v1.repay_typ, v1.repay_typ_desc, v2.repay_typ, v2.repay_typ_desc) == ("5", None, "7", "等额本息")
    assert (v1.useofunds, v1.useofunds_js, v2.useofunds_js, v2.loan_business_typ) == (
        "working capital", "流动资金", "其他", "9")
    assert (v1.is_first_loan_tag, v1.is_first_report_loan_tag, v1.campus_consu_loan_flg) == ("1", "1", "2")
    assert (v1.poverty_alle, v1.undertak_guar_type, v1.transfers_loan_flg) == ("Y", "Z", "Y")
    assert (v1.loan_grade_cd, v1.main_guaranty_typ, v1.loan_kind_cd) == ("2", "1", "1")
