"""CL_1 (corporate credit) on hand-built source tables."""

import datetime as dt
from decimal import Decimal as d

from lendgrid.rundate import RunDate
from lendgrid.segments import Catalog
from lendgrid.segments.corporate import ACCT_TYP_DICT, BAIL_CURRENCY_DICT, GREEN_TYPE_DICT, corporate_loans

RUN = RunDate(dt.date(2024, 1, 31))
B, O, P = dt.date(2024, 1, 1), dt.date(9999, 12, 31), "202401"


def tbl(spark, cols: str, rows=(), history=True, types=None):
    """``cols`` is a space-separated column list (strings unless typed in
    ``types``); rows are dicts."""
    names = cols.split()
    types = types or {}
    ddl = ", ".join(f"{c} {types.get(c, 'string')}" for c in names)
    if history:
        ddl += ", begndt date, overdt date, partid string"
    data = [tuple(r.get(c) for c in names) + ((B, O, P) if history else ()) for r in rows]
    return spark.createDataFrame(data, ddl)


BD_COLS = ("serialno businesstype relativeserialno2 relativeserialno1 customerid mfcustomerid businesscurrency mforgid "
           "overduebalance dullbalance badbalance interestbalance1 interestbalance2 finebalance1 finebalance2 "
           "finishdate actualmaturity putoutdate maturity extendtimes businesssum balance overduedate intdate "
           "businessrate2 iccyc bailsum lcstatus")
BD_TYPES = {c: "decimal(20,2)" for c in ("overduebalance dullbalance badbalance interestbalance1 interestbalance2 "
                                         "finebalance1 finebalance2 businesssum balance bailsum").split()}
BD_TYPES.update(extendtimes="int", businessrate2="decimal(12,6)")
BC_COLS = ("serialno artificialno classifyresult ictype baserate occurtype manageuserid baseratetype greenloanpurpose "
           "ourrole direction businesstype businessprop vouchtype isftz bailcurrency bailratio purpose termmonth "
           "permanentassets")


def frames(spark):
    z = d("0")
    duebills = [
        dict(serialno="D1", businesstype="1010010", relativeserialno2="C1", relativeserialno1="PO1", customerid="CU1",
             businesscurrency="01", mforgid="0090102", overduebalance=d("100"), dullbalance=z, badbalance=z,
             interestbalance1=d("5"), interestbalance2=z, finebalance1=d("1"), finebalance2=z,
             actualmaturity="20240301", putoutdate="20230101", maturity="20240301", extendtimes=0,
             businesssum=d("1000"), balance=d("900"), overduedate="20240110", intdate="20240115",
             businessrate2=d("4.5"), iccyc="10", bailsum=d("50"), lcstatus="L1"),
        dict(serialno="D2", businesstype="2070", relativeserialno2="C2", customerid="CU2", finishdate="20240120",
             putoutdate="20230601", maturity="20240601", extendtimes=0, businesssum=d("10"), balance=z),
        dict(serialno="D3", businesstype="1020010", relativeserialno2="C1", customerid="CU1", extendtimes=0),
        dict(serialno="X9", businesstype="1130020", customerid="CU1", extendtimes=0, actualmaturity="20240301"),
    ]
    contracts = [
        dict(serialno="C1", artificialno="ART1", classifyresult="02", ictype="010", baserate=d("4.35"), occurtype="020",
             manageuserid="M1", baseratetype="005", greenloanpurpose="G1", ourrole="A0100", direction="C2710*",
             businesstype="1010010", businessprop="60%", vouchtype="02010", isftz="N", bailcurrency="CNY1",
             purpose="Working", termmonth=14, permanentassets="1"),
        dict(serialno="C2", ictype="020", baserate=d("3"), occurtype="090", baseratetype="010", ourrole="A0291",
             businesstype="2070", vouchtype="005", purpose="Entrusted"),
    ]
    return {
        "OMI.CL_BUSINESS_DUEBILL_HS": tbl(spark, BD_COLS, duebills, types=BD_TYPES),
        "OMI.CL_BUSINESS_CONTRACT_HS": tbl(spark, BC_COLS, contracts,
                                           types={"baserate": "decimal(12,6)", "termmonth": "int"}),
        "OMI.CL_ADVANCED_INFO_HS": tbl(spark, "duebillno oldduebillno", [dict(duebillno="X9", oldduebillno="D2")]),
        "OMI.BS_ACCEPT_DETAILS_VIEW_HS": tbl(spark, "warrant_no draft_number", [dict(warrant_no="D2", draft_number="DR2")]),
        "OMI.CL_CUSTOMER_INFO_HS": tbl(spark, "customerid mfcustomerid customername inputdate", [
            dict(customerid="CU1", mfcustomerid="MF1", customername="Acme", inputdate="20230101")]),
        "OMI.CL_CODE_LIBRARY_HS": tbl(spark, "codeno itemno itemname bankno itemdescribe", [
            dict(codeno="Currency", itemno="01", itemname="RMB", bankno="CNY"),
            dict(codeno="Industry", itemno="A0100", itemdescribe="7xx"),
            dict(codeno="Industry", itemno="A0291", itemdescribe="1xx"),
            dict(codeno="Other", itemno="A0291", itemdescribe="2xx")]),
        "OMI.CL_BUSINESS_TYPE_HS": tbl(spark, "typeno typename", [dict(typeno="1010010", typename="银团贷款"),
                                                                   dict(typeno="1130020", typename="承兑汇票垫款")]),
        "OMI.CL_ENT_INFO_HS": tbl(spark, "customerid countrycode orgtype scope creditdate industrytype", [
            dict(customerid="CU1", countrycode="USA", scope="4", creditdate="20230101", industrytype="IND1"),
            dict(customerid="CU2", countrycode="CHN", industrytype="IND2")]),
        "OMI.CL_BUSINESS_PUTOUT_HS": tbl(spark, "serialno baserate businessrate2 paymenttype businesssum iccyc "
                                                "mostlyduebillno corpuspaymethod bailaccount insideaccountremark", [
            dict(serialno="PO1", baserate=d("4.35"), businessrate2=d("4.6"), paymenttype="1", businesssum=d("1000"),
                 iccyc="050", mostlyduebillno="OLDLN", corpuspaymethod="020", bailaccount="BA1",
                 insideaccountremark="RMK-")],
            types={"baserate": "decimal(12,6)", "businessrate2": "decimal(12,6)", "businesssum": "decimal(20,2)"}),
        "OMI.CL_CONTRACT_RELATIVE_HS": tbl(spark, "serialno objectno", [dict(serialno="C1", objectno="G1"),
                                                                         dict(serialno="C1", objectno="G2")]),
        "OMI.CL_GUARANTY_CONTRACT_HS": tbl(spark, "serialno vouchtype guarantytype contractstatus", [
            dict(serialno="G1", vouchtype="02010", guarantytype="050", contractstatus="020"),
            dict(serialno="G2", vouchtype="010", guarantytype="010", contractstatus="040")]),
        "OMI.KN_KLNB_DKHKSX_HS": tbl(spark, "dkjiejuh benqqish zongqish huankzhh huankfsh dzhhkjih hkzhouqi", [
            dict(dkjiejuh="D1", benqqish=3, zongqish=12, huankzhh="RA1", huankfsh="3", hkzhouqi="1M-x")],
            types={"benqqish": "int", "zongqish": "int"}),
        "OMI.KN_KLNA_DKZHZB_HS": tbl(spark, "dkjiejuh dkzhhzht ysyjlixi ysyjfaxi kehuhaoo chanpdma dkzhangh", [
            dict(dkjiejuh="D1", dkzhhzht="0", ysyjlixi=d("2"), ysyjfaxi=d("1"), kehuhaoo="KH1", chanpdma="P1",
                 dkzhangh="ACC1")], types={"ysyjlixi": "decimal(20,2)", "ysyjfaxi": "decimal(20,2)"}),
        "OMI.KN_KFAP_YEWUPZ_HS": tbl(spark, "yewusx01 yewubima", [dict(yewusx01="P1", yewubima="YB1")]),
        "OMI.KN_KFAP_YESHUX_HS": tbl(spark, "yewubima yeshux09", [dict(yewubima="YB1", yeshux09="BM_X1234")]),
        "OMI.KN_KFAP_NEIBHS_HS": tbl(spark, "nbuhesdm kemuhaoo", [dict(nbuhesdm="X1234", kemuhaoo="11520801")]),
        "OMI.KN_KFAP_KJKEMU_HS": tbl(spark, "kemuhaoo kemumnch", [dict(kemuhaoo="11520801", kemumnch="普通贷款")]),
        "OMI.KN_KLNB_DKJXSX_HS": tbl(spark, "dkjiejuh xctxriqi xcyqtxrq xcnytxrq",
                                     [dict(dkjiejuh="D1", xcyqtxrq="20240601")]),
        "OMI.KN_KLNB_DKFKSX_HS": tbl(spark, "dkjiejuh dkrzhzhh", [dict(dkjiejuh="D1", dkrzhzhh="EA1")]),
        "OMI.KN_KTAA_NBFHZH_HS": tbl(spark, "zhanghao zhyngyjg zhanghmc", [
            dict(zhanghao="EA1", zhyngyjg="ORGX", zhanghmc="InternalName")]),
        "OMI.KN_KFAA_NBFHZH_HS": tbl(spark, "zhanghao"),
        "OMI.KN_KTAB_CFTYDQ_HS": tbl(spark, "zhanghao"),
        "OMI.KN_KTAB_CFTYHQ_HS": tbl(spark, "zhanghao"),
        "OMI.KN_KTAB_DXZDJB_HS": tbl(spark, "daixzhxh"),
        "L_PUBL_ORG_BRA": tbl(spark, "org_num org_nam data_date", [
            dict(org_num="ORGX", org_nam="Branch X", data_date="20240131"),
            dict(org_num="ORGX", org_nam="Stale", data_date="20231231")], history=False),
        "OMI.KN_KLNB_DKSTZF_HS": tbl(spark, "dkjiejuh dfzhangh dfzhkhhm stzfclzt"),
        "OMI.IS_BPD_HS": tbl(spark, "jjh inr", [dict(jjh="X9", inr="I9")]),
        "OMI.IS_TRN_HS": tbl(spark, "objinr inr objtyp inifrm relflg", [
            dict(objinr="I9", inr="T9", objtyp="BPD", inifrm="BPTFFT", relflg="R")]),
        "OMI.IS_GLE_HS": tbl(spark, "trninr act dbtcdt dbtdft", [dict(trninr="T9", act="GA9", dbtcdt="C", dbtdft="LO-CO1")]),
        "OMI.KN_KLNB_DZQGJH_HS": tbl(spark, "dkjiejuh daoqriqi", [dict(dkjiejuh="D1", daoqriqi="20240215"),
                                                                  dict(dkjiejuh="D1", daoqriqi="20240110")]),
        "OMI.CL_USER_INFO_HS": tbl(spark, "userid certid", [dict(userid="M1", certid="CERT1")]),
        "OMI.HR_BD_PSNDOC_HS": tbl(spark, "id code", [dict(id="CERT1", code="c00123")]),
        "OMI.KN_KDPA_KEHUZH_HS": tbl(spark, "kehuzhao kehuzhmc kaihjigo", [
            dict(kehuzhao="EA1", kehuzhmc="Borrower", kaihjigo="0100001"),
            dict(kehuzhao="RA1", kehuzhmc="Payer", kaihjigo="0120001")]),
        "OMI.KN_KLNB_ZCZRMX_HS": tbl(spark, "dkjiejuh chulizht", [dict(dkjiejuh="D1", chulizht="1")]),
        "OMI.KN_KLNB_DKZHQG_HS": tbl(spark, "dkjiejuh ysqianxi csqianxi yshofaxi cshofaxi benqizht", [
            dict(dkjiejuh="D1", ysqianxi=d("1"), csqianxi=z, yshofaxi=z, cshofaxi=z, benqizht="1"),
            dict(dkjiejuh="D1", ysqianxi=d("2"), csqianxi=z, yshofaxi=z, cshofaxi=z, benqizht="1"),
            dict(dkjiejuh="D1", ysqianxi=d("2"), csqianxi=z, yshofaxi=z, cshofaxi=z, benqizht="0")],
            types={c: "decimal(20,2)" for c in ("ysqianxi", "csqianxi", "yshofaxi", "cshofaxi")}),
        "OMI.KN_KBRP_JGCSHU_HS": tbl(spark, "jigouhao jigouzwm diqdaima", [
            dict(jigouhao="0100001", jigouzwm="Org010"), dict(jigouhao="0120001", jigouzwm="Org012"),
            dict(jigouhao="0090101", diqdaima="210200")]),
        "OMI.CL_ARGI_CONTRACT_HS": tbl(spark, "serialno"),
        "OMI.CL_CUSTOMER_SPECIAL_HS": tbl(spark, "serialno sectiontype", [dict(serialno="C1", sectiontype="95")]),
        "OMI.I9_ECL_FINAL_RESULT_HS": tbl(spark, "asset_no ecl_final", [dict(asset_no="D1", ecl_final=d("12.5"))],
                                          types={"ecl_final": "decimal(20,2)"}),
        "OMI.KN_KLNL_DKJXMX_HS": tbl(spark, "dkjiejuh jixiriqi ysyjlixi ysyjfaxi ysyjxxsh", [
            dict(dkjiejuh="D1", jixiriqi="20240110", ysyjlixi=d("10"), ysyjfaxi=d("1"), ysyjxxsh=d("2")),
            dict(dkjiejuh="D1", jixiriqi="20230110", ysyjlixi=d("50"), ysyjfaxi=z, ysyjxxsh=z)], history=False,
            types={c: "decimal(20,2)" for c in ("ysyjlixi", "ysyjfaxi", "ysyjxxsh")}),
        "OMI.KN_KLNL_DKBGMX_HS": tbl(spark, "dkjiejuh xshjuzhi jiaoyirq zhhujizd xuhaoooo beizhuuu", [
            dict(dkjiejuh="D1", xshjuzhi="RA1", jiaoyirq="20240105", zhhujizd="huankzhh", xuhaoooo=2, beizhuuu="[x]note"),
            dict(dkjiejuh="D1", xshjuzhi="RA1", jiaoyirq="20240101", zhhujizd="huankzhh", xuhaoooo=1, beizhuuu="[y]old")],
            history=False, types={"xuhaoooo": "int"}),
        "OMI.CL_BUSINESS_WASTEBOOK_HS": tbl(spark, "relativeserialno serialno occurdate occursubject", [
            dict(relativeserialno="D1", serialno="W1", occurdate="20240105", occursubject="0"),
            dict(relativeserialno="D1", serialno="W2", occurdate="20240120", occursubject="0"),
            dict(relativeserialno="D1", serialno="W3", occurdate="20231220", occursubject="0")], history=False),
        "OMI.CL_BUSINESS_EXTENSION_HS": tbl(spark, "relativeserialno lastmaturity"),
        "OMI.KN_KCFB_CFDGJC_HS": tbl(spark, "kehuzhwm kehuhaoo hydmxlei hangyedm"),
        "OMI.CL_CUSTOMER_XINDAIKEHU_HS": tbl(spark, "mfcustomerid industrytype"),
        "M_DICT_REMAPPING_DL": tbl(spark, "business_type dict_code ori_values new_values", [
            dict(business_type="RSUM", dict_code=ACCT_TYP_DICT, ori_values="1010010", new_values="0203"),
            dict(business_type="RSUM", dict_code=GREEN_TYPE_DICT, ori_values="G1", new_values="GT1"),
            dict(business_type="RSUM", dict_code=BAIL_CURRENCY_DICT, ori_values="CNY1", new_values="CNY")],
            history=False),
    }


def test_corporate_segment_rows(spark):
    rows = {r.loan_num: r for r in corporate_loans(Catalog.frames(frames(spark)), RUN).collect()}
    assert set(rows) == {"D1", "D2", "X9"}                   # bill financing excluded, entrusted kept
    d1, d2, x9 = rows["D1"], rows["D2"], rows["X9"]
    assert (d1.acct_num, d1.acct_sts, d1.acct_sts_fhz, d1.acct_sts_xmdk, d2.acct_sts) == ("ART1", "2", "1", "2", "3")
    assert (d1.acct_typ, d1.acct_typ_desc, d1.accu_int_amt, d1.accu_int_flg) == ("0203", "银团贷款", d("3"), "N")
    assert (d1.base_int_rat, d2.base_int_rat, d1.cumulate_term_num, d1.current_term_num) == ("4.35000", None, 2, 3)
    assert (d1.curr_cd, d1.cust_id, d1.departmentd, d1.drawdown_type, d1.emp_id) == ("CNY", "MF1", "dgdk", "B", "00123")
    assert (d1.entrust_pay_amt, d1.independence_pay_amt, d1.float_type, d1.fund_use_loc_cd) == (d("1000"), None, "C", "O")
    assert (d1.generalize_loan_flg, d1.gov_bondmorg_flg, d1.green_loan_flg, d1.green_loan_type) == ("Y", "Y", "Y", "GT1")
    assert (d1.guaranty_typ, d1.indust_stg_type, d2.indust_stg_type, d1.indust_tran_flg) == ("B01", "1", None, "1")
    assert (d1.int_rate_typ, d2.int_rate_typ, x9.int_rate_typ) == ("L9", "F", "F")
    assert (d1.int_repay_freq, d1.int_repay_freq_desc, d1.is_first_report_loan_tag, d2.is_repay_options) == (
        "99", "手工计息", "Y", "Y")
    assert (d1.item_cd, x9.item_cd, d1.i_od_dt) == ("11520801", "11420101", dt.date(2024, 1, 15))
    assert (d1.loan_acct_bank, d1.loan_acct_name, d1.loan_acct_num, x9.loan_acct_num) == ("Org010", "Borrower", "EA1", "GA9")
    assert (d1.loan_business_typ, x9.loan_business_typ, d1.loan_fhz_num, d1.loan_grade_cd, d2.loan_grade_cd) == (
        "2", "9", "ACC1", "2", "1")
    assert (d1.loan_kind_cd, d1.loan_num_old, d2.loan_num_old, d1.loan_purpose_area) == ("3", "OLDLN", None, "210200")
    assert (d1.loan_purpose_cd, d2.loan_purpose_cd, d1.loan_ratio, d1.loan_sell_int) == ("C2710", "IND2", "60%", "Y")
    assert (d1.main_guaranty_typ, d1.maturity_dt, x9.maturity_dt) == ("1", dt.date(2024, 3, 1), None)
    assert (d1.year_int_incom, d1.next_int_pay_dt, d1.next_repricing_dt) == (d("9"), dt.date(2024, 2, 15), dt.date(2024, 6, 1))
    assert (d1.od_days, d1.od_flg, d1.od_int, d1.od_int_obs, d1.od_loan_acct_bal) == (22, "Y", d("6"), 0, d("100"))
    assert (d1.org_num, x9.orig_acct_no, d1.orig_term, d1.oversea_ann_loan_flag) == ("0090101", "DR2", 425, "Y")
    assert (d1.pay_acct_bank, d1.pay_acct_num, x9.pay_acct_num, d1.pricing_base_type, d1.p_od_dt) == (
        "Org012", "RA1", "GA9", "C", dt.date(2024, 1, 10))
    assert (d1.real_int_rat, d1.renew_flg, d2.renew_flg, d1.repay_flg, d1.repay_term_num) == (d("4.5"), "N", "Y", "Y", 12)
    assert (d1.repay_typ, d1.repay_typ_desc, d1.security_acct_num, d1.security_amt, d1.security_curr) == (
        "1", "等额本息", "BA1", d("50"), "CNY")
    assert (d1.useofunds, x9.useofunds, d1.yangtze_river_loan_flg, d1.ppl_repay_freq) == ("Working", "Entrusted", "Y", "03")
    assert (d1.remark, d2.remark, d1.orig_term_bc, d1.drawdown_num) == ("RMK-note", "", 14, "W2")
    assert (d1.guaranty_typ_js, d1.cust_id_js, d1.product_type_js, x9.product_type_js) == ("B01", "MF1", "F023", "F051")
    assert (d1.lcstatus, d1.acct_num_cqcs, d1.sp_prov_amt) == ("L1", "C1", d("12.5"))


def test_due_plan_is_read_as_of_the_run_date(spark):
    """Rows that expired by D, begin after it or lie in another month's partition do not count."""
    own = frames(spark)
    plan = own["OMI.KN_KLNB_DZQGJH_HS"]
    stale = spark.createDataFrame([("D1", "20240205", B, RUN.d, P), ("D1", "20240206", B, O, "202312"),
                                   ("D1", "20240207", dt.date(2024, 2, 1), O, P)], plan.schema)
    own["OMI.KN_KLNB_DZQGJH_HS"] = plan.unionByName(stale)
    rows = {r.loan_num: r for r in corporate_loans(Catalog.frames(own), RUN).collect()}
    assert rows["D1"].next_int_pay_dt == dt.date(2024, 2, 15)
