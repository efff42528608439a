"""PL_2 (personal loans) on hand-built source tables, reading back the detail."""

import datetime as dt
from decimal import Decimal as d

from lendgrid.rundate import RunDate
from lendgrid.segments import Catalog
from lendgrid.segments.personal import GREEN_PURPOSE_DICT, USEOFUNDS_DICT, personal_loans

RUN = RunDate(dt.date(2024, 1, 31))
B, O, P = dt.date(2024, 1, 1), dt.date(9999, 12, 31), "202401"
H = "begndt date, overdt date, partid string"

LOAN_COLS = {
    "loan_no": "string", "lnpa_loan_typ": "string", "sts": "string", "debt_sts": "string", "next_due_dt": "string",
    "last_due_dt": "string", "base_rate": "decimal(12,6)", "sprd": "decimal(12,6)", "int_adj_pct": "decimal(12,6)",
    "orig_prcp": "decimal(20,2)", "os_prcp": "decimal(20,2)", "actv_dt": "string", "last_setl_dt": "string",
    "prps_fin": "string", "ctif_id_type": "string", "ctif_id_no": "string", "ctif_iss_ctry": "string",
    "cr_line": "string", "aofr_acct_offcr_cde": "string", "bhdt_bch_cde": "string", "ls_appl_seq": "string",
    "abs_seq": "string", "sale_ind": "string", "cis_sts": "string", "endowment_ins_no": "string",
    "recourse": "string", "cust_ref": "string", "loan_grd": "string", "refinc_furchrg_no": "string",
    "refinc_furchrg_ind": "string", "main_gur_typ": "string", "rate_mode": "string", "next_repc_dt": "string",
    "next_repc_option": "string", "next_repc_num": "string", "instm_freq_unit_typ": "string",
    "instm_freq_num_unit": "string", "loan_target": "string", "adj_bf_prcp": "decimal(20,2)", "loan_tnr": "int",
    "tnr": "int",
}


def table(spark, schema: dict, rows: list[dict], history=True):
    cols = list(schema)
    data = [tuple(r.get(c) for c in cols) + ((B, O, P) if history else ()) for r in rows]
    ddl = ", ".join(f"{c} {t}" for c, t in schema.items()) + (", " + H if history else "")
    return spark.createDataFrame(data, ddl)


def strs(*cols):
    return {c: "string" for c in cols}


def loan(**kw):
    base = dict(lnpa_loan_typ="101001", sts="ACTV", debt_sts="NORM", next_due_dt="20240215",
                last_due_dt="20250115", base_rate=d("4"), sprd=d("0.5"), int_adj_pct=d("10"), orig_prcp=d("1000"),
                os_prcp=d("600"), actv_dt="20220101", ctif_id_type="T", ctif_id_no="ID1", ctif_iss_ctry="CN",
                cr_line="CL1", aofr_acct_offcr_cde="ABC123", bhdt_bch_cde="BR1", ls_appl_seq="AP1", sale_ind="N",
                main_gur_typ="COLL", rate_mode="RV", next_repc_dt="20240701", next_repc_option="FIX",
                next_repc_num="THREEMONTH", instm_freq_unit_typ="M", instm_freq_num_unit="1", loan_target="T1",
                adj_bf_prcp=d("3"), loan_tnr=24, tnr=24)
    base.update(kw)
    return base


def build_frames(spark):
    sched_s = {"loan_loan_no": "string", "loan_lnpa_loan_typ": "string", "perd_no": "int", "due_dt": "string",
               "prcp_amt": "decimal(20,2)", "setl_prcp": "decimal(20,2)", "int_amt": "decimal(20,2)",
               "setl_int": "decimal(20,2)", "int_rate": "decimal(12,6)", "last_setl_dt": "string"}
    z, h, t = d("0"), d("100"), d("10")
    sched = [
        dict(loan_loan_no="P1", loan_lnpa_loan_typ="101001", perd_no=0, due_dt="20220101", prcp_amt=z, setl_prcp=z,
             int_amt=z, setl_int=z, int_rate=d("4.9")),
        dict(loan_loan_no="P1", loan_lnpa_loan_typ="101001", perd_no=1, due_dt="20231215", prcp_amt=h, setl_prcp=h,
             int_amt=t, setl_int=t, last_setl_dt="20231215"),
        dict(loan_loan_no="P1", loan_lnpa_loan_typ="101001", perd_no=2, due_dt="20240115", prcp_amt=h, setl_prcp=z,
             int_amt=t, setl_int=z),
        dict(loan_loan_no="P1", loan_lnpa_loan_typ="101001", perd_no=3, due_dt="20240215", prcp_amt=h, setl_prcp=z,
             int_amt=t, setl_int=z),
        dict(loan_loan_no="P2", loan_lnpa_loan_typ="103001", perd_no=1, due_dt="20231201", prcp_amt=h, setl_prcp=h,
             int_amt=t, setl_int=t, last_setl_dt="20231225"),
    ]
    loans = [
        loan(loan_no="P1", next_due_dt="20240115", prps_fin="05", endowment_ins_no="GI", loan_grd="200"),
        loan(loan_no="P2", lnpa_loan_typ="103001", sts="SETL", last_due_dt="20240120", actv_dt="20231201",
             ctif_id_no="ID2", aofr_acct_offcr_cde="U1", ls_appl_seq="AP2", rate_mode="FX",
             instm_freq_unit_typ="W", instm_freq_num_unit="2", refinc_furchrg_ind="E"),
        loan(loan_no="P3", sts="SETL"),
        loan(loan_no="P4", sts="REVS"),
        loan(loan_no="P5", orig_prcp=d("0")),
        loan(loan_no="P6", sts="SETL", debt_sts="CHRGO"),
    ]
    maps = [("RSUM", USEOFUNDS_DICT, "05", "Car"), ("RSUM", GREEN_PURPOSE_DICT, "GI%", "GPX")]
    frames = {
        "OMI.PL_LOAN_HS": table(spark, LOAN_COLS, loans),
        "OMI.PL_PAYM_SCHED_HS": table(spark, sched_s, sched),
        "OMI.PL_OD_INT_LOG_HS": table(spark, {"loan_typ": "string", "loan_no": "string", "perd_no": "int",
                                              "int_amt": "decimal(20,2)", "setl_int": "decimal(20,2)",
                                              "wv_int": "decimal(20,2)"},
                                      [dict(loan_typ="101001", loan_no="P1", perd_no=1, int_amt=d("5"), setl_int=z,
                                            wv_int=d("5"))]),
        "OMI.PL_ABS_LOAN_DETL_HS": table(spark, strs("loan_no", "abs_seq", "sale_dt"), []),
        "OMI.PL_LOAN_ACTV_LOG_HS": table(spark, strs("loan_no", "loan_drawdn_no"), [dict(loan_no="P1", loan_drawdn_no="DRW1")]),
        "OMI.PL_LS_LOAN_GRP_HS": table(spark, strs("loan_grp_code", "loan_grp_pri_desc"),
                                       [dict(loan_grp_code="10", loan_grp_pri_desc="个人住房贷款")]),
        "OMI.PL_CUST_INFO_HS": table(spark, strs("id_no", "id_type", "iss_ctry", "cust_no"), [
            dict(id_no="ID1", id_type="T", iss_ctry="CN", cust_no="X"),
            dict(id_no="ID2", id_type="T", iss_ctry="CN", cust_no="CUST2")]),
        "OMI.PL_BCH_DEPT_HS": table(spark, strs("bch_cde", "dist_cde", "corebank_bch"), [
            dict(bch_cde="BR1", dist_cde="460400", corebank_bch="CB0"), dict(bch_cde="BC1", corebank_bch="CB1"),
            dict(bch_cde="BC2", corebank_bch="CB2")]),
        "OMI.PL_GAST_BAD_DEBT_HS": table(spark, strs("loan_no", "last_appr_dt"), [dict(loan_no="P6", last_appr_dt="20240110")]),
        "OMI.PL_LOAN_INFO_HS": table(spark, {"loan_no": "string", **{c: "decimal(20,2)" for c in (
            "int_recvl_amt", "odi_recvl_amt", "int_susp_recvl_amt", "int_ndv_recvl_amt", "odi_susp_recvl_amt",
            "odi_ndv_recvl_amt")}}, [dict(loan_no="P1", int_recvl_amt=d("1"), odi_recvl_amt=d("2"),
                                          int_susp_recvl_amt=d("1"), int_ndv_recvl_amt=d("1"),
                                          odi_susp_recvl_amt=d("1"), odi_ndv_recvl_amt=d("1"))]),
        "OMI.PL_LOAN_PARA_HS": table(spark, strs("loan_typ", "instm_ln_ind", "irreg_ind"), [
            dict(loan_typ="101001", instm_ln_ind="Y", irreg_ind="N"), dict(loan_typ="103001", instm_ln_ind="N", irreg_ind="Y")]),
        "OMI.PL_LS_APPL_LOAN_TARGET_HS": table(spark, strs("ls_appl_seq", "appl_loan_target_field"), [
            dict(ls_appl_seq="AP1", appl_loan_target_field="TU"), dict(ls_appl_seq="AP1", appl_loan_target_field="TC")]),
        "OMI.PL_LS_APPL_PPSL_HS": table(spark, strs("ls_appl_seq", "appl_ppsl_pay_way"), [
            dict(ls_appl_seq="AP1", appl_ppsl_pay_way="ST"), dict(ls_appl_seq="AP2", appl_ppsl_pay_way="ZZ")]),
        "OMI.PL_CR_LN_HDR_HS": table(spark, strs("ctif_id_type", "ctif_id_no", "ctif_iss_ctry", "cr_line", "revv_ind"), [
            dict(ctif_id_type="T", ctif_id_no="ID1", ctif_iss_ctry="CN", cr_line="CL1", revv_ind="Y")]),
        "OMI.PL_USR_PRFL_HS": table(spark, strs("usr_id", "ctif_id_no"), [dict(usr_id="U1", ctif_id_no="PX")]),
        "OMI.HR_BD_PSNDOC_HS": table(spark, strs("id", "code"), [dict(id="PX", code="EMP9")]),
        "OMI.PL_GL_TX_HS": table(spark, strs("gl_ac_no", "loan_no", "func_id", "seq_no"), [
            dict(gl_ac_no="GL9", loan_no="P2", func_id="LNLNACTF", seq_no="3")], history=False),
        "OMI.PL_LS_APPL_DRAWDN_HS": table(spark, strs("ls_appl_seq", "ls_appl_drawdn_seq"), [
            dict(ls_appl_seq="AP1", ls_appl_drawdn_seq="DS1"), dict(ls_appl_seq="AP1", ls_appl_drawdn_seq="DS2")]),
        "OMI.PL_LS_APPL_DRAWDN_DISB_HS": table(spark, strs(
            "ls_appl_drawdn_seq", "appl_drawdn_disb_ref", "appl_drawdn_disb_name", "appl_drawdn_disb_ac_bch"), [
            dict(ls_appl_drawdn_seq="DS2", appl_drawdn_disb_ref="REF2", appl_drawdn_disb_name="NM2",
                 appl_drawdn_disb_ac_bch="BC2")]),
        "OMI.PL_ATPY_INSTR_HS": table(spark, strs("loan_loan_no", "acct_no", "bkbh_bank_bch_cde", "name"), [
            dict(loan_loan_no="P1", acct_no="ZA1", bkbh_bank_bch_cde="BC1", name="ZN1")]),
        "OMI.PL_GL_ASSGN_HS": table(spark, strs("ai_recvl_gl", "lnpa_loan_typ"), [dict(ai_recvl_gl="LG1", lnpa_loan_typ="101001")]),
        "OMI.PL_G_L_ACCT_NO_HS": table(spark, strs("ldgr_cde", "gl_ac_no"), [dict(ldgr_cde="LG1", gl_ac_no="GLA")]),
        "OMI.KN_KFAP_KJKEMU_HS": table(spark, strs("kemuhaoo", "kemumnch"), []),
        "OMI.KN_KBRP_JGCSHU_HS": table(spark, strs("jigouhao", "jigouzwm"), [
            dict(jigouhao="CB1", jigouzwm="Org1"), dict(jigouhao="CB2", jigouzwm="Org2")]),
        "OMI.PL_SETLMT_LOG_HS": table(spark, strs("loan_no", "val_dt"), [dict(loan_no="P2", val_dt="20240120")]),
        "URDM.SJBS_DKDBFS_LS": table(spark, strs("loan_no", "l_type"), [dict(loan_no="P1", l_type="B01")], history=False),
        "URDM.DKDBFS_LS_JS": table(spark, strs("loan_no", "l_type"), [dict(loan_no="P1", l_type="B99")], history=False),
        "OMI.PL_LOAN_TARGET_HS": table(spark, strs("code", "weight_code"), [dict(code="T1", weight_code="ABCDE")]),
        "OMI.PL_LOAN_SCHD_TERM_HS": table(spark, strs("loan_no", "repaym_opt"), [dict(loan_no="P2", repaym_opt="IO")]),
        "OMI.PL_RSTR_LOG_HS": table(spark, strs("loan_no", "rstr_typ", "create_dt"), [
            dict(loan_no="P2", rstr_typ="TN", create_dt="2024-01-05 10:00:00")], history=False),
        "URDM.PL_LBI_R_LOAN_DETAIL_HS": spark.createDataFrame([
            (RUN.d, "P1", "20250115", "200", d("100"), d("5"), z, "经营"),
            (RUN.d, "P2", None, "100", z, z, z, "消费"),
            (dt.date(2023, 12, 31), "P1", "x", "500", z, z, z, "x")],
            "rpt_dt date, loan_no string, last_due_dt string, loan_grd string, od_prcp_amt decimal(20,2), "
            "od_int_amt decimal(20,2), od_od_int_amt decimal(20,2), loan_grp2 string"),
        "M_DICT_REMAPPING_DL": spark.createDataFrame(maps, "business_type string, dict_code string, ori_values string, "
                                                           "new_values string"),
    }
    return frames


def test_personal_segment_rows(spark):
    frames = build_frames(spark)
    rows = {r.acct_num: r for r in personal_loans(Catalog.frames(frames), RUN).collect()}
    assert set(rows) == {"P1", "P2", "P6"}                 # unsettled-without-date, reversed, zero principal dropped
    p1, p2, p6 = rows["P1"], rows["P2"], rows["P6"]
    assert (p1.acct_sts, p2.acct_sts, p6.acct_sts) == ("2", "3", None)
    assert (p1.od_flg, p1.od_days, p2.od_flg) == ("Y", 16, "N")
    assert (p1.consecute_term_num, p1.cumulate_term_num, p1.current_term_num) == (1, 1, 3)
    assert (p2.consecute_term_num, p2.cumulate_term_num) == (0, 1)   # late settlement counts as arrears
    assert (p1.p_od_dt, p1.i_od_dt, p1.od_loan_acct_bal, p1.accu_int_amt) == (
        dt.date(2024, 1, 15), dt.date(2024, 1, 15), d("100"), d("10"))
    assert (p1.drawdown_real_int_rat, p1.real_int_rat, p1.drawdown_base_int_rat) == (d("4.9"), d("4.95"), d("4.5"))
    assert (p2.finish_dt, p6.finish_dt, p6.cancel_flg, p6.loan_acct_bal) == (
        dt.date(2024, 1, 20), dt.date(2024, 1, 10), "Y", 0)
    assert (p1.acct_typ, p1.acct_typ_js, p2.acct_typ, p2.acct_typ_js, p2.acct_typ_desc) == (
        "010101", "010101", "010199", "010201", "其他个人住房贷款")
    assert (p1.repay_typ, p1.int_repay_freq, p1.int_rate_typ) == ("1", "03", "L3")
    assert (p2.repay_typ, p2.int_repay_freq, p2.int_rate_typ, p2.repay_typ_desc, p2.int_repay_freq_desc) == (
        "5", "99", "F", "按双周", "按双周结息")
    assert (p1.drawdown_type, p1.entrust_pay_amt, p1.independence_pay_amt) == ("B", d("1000"), None)
    assert (p2.drawdown_type, p2.entrust_pay_amt, p2.independence_pay_amt) == ("A", None, d("1000"))
    assert (p1.loan_acct_num, p1.loan_acct_name, p1.loan_acct_bank, p1.pay_acct_bank, p1.pay_acct_num) == (
        "REF2", "NM2", "Org2", "Org1", "ZA1")
    assert (p2.loan_acct_num, p2.loan_acct_name) == ("GL9", None)
    assert (p1.cust_id, p2.cust_id, p1.emp_id, p2.emp_id) == ("ID1", "CUST2", "ABC123", "EMP9")
    assert (p1.useofunds, p2.useofunds, p1.green_purpose_cd, p1.green_balance) == ("Car", "其他贷款", "GPX", d("600"))
    assert (p1.loan_purpose_area, p1.loan_purpose_cd, p1.item_cd, p1.loan_num) == ("000000", "ET1", "GLA", "DRW1")
    assert (p1.next_repricing_dt, p2.next_repricing_dt) == (dt.date(2024, 7, 1), dt.date(2024, 1, 20))
    assert (p1.is_repay_options, p2.is_repay_options, p1.circle_loan_flg, p2.circle_loan_flg) == ("N", "Y", "Y", "N")
    assert (p1.od_int, p1.od_int_obs) == (d("6"), d("4"))
    assert (p1.indust_tran_flg, p1.loans_to_culture_flag, p1.indust_stg_type) == ("1", "Y", "N")
    assert (p1.guaranty_typ, p1.guaranty_typ_js, p1.loan_grade_cd, p1.main_guaranty_typ) == ("B01", "B99", "2", "1")
    assert (p1.od_type_js, p1.loan_status_js, p1.loan_type_js) == ("03", "LS03", "经营")
    assert (p2.od_type_js, p2.loan_status_js, p2.renew_flg) == ("", "LS04", "Y")
    assert p1.year_int_incom == "0" and p1.departmentd == "grdk"


def test_job_writes_detail_then_reads_it_back(spark):
    import os
    import tempfile

    from lendgrid.job import LedgerJob, read_ledger
    from lendgrid.operators.ledger import LEDGER

    frames = build_frames(spark)
    detail = frames.pop("URDM.PL_LBI_R_LOAN_DETAIL_HS")
    root = tempfile.mkdtemp(prefix="lendgrid-pl-")
    job = LedgerJob(spark, Catalog.frames(frames), RUN, os.path.join(root, "ledger"), {"PL_2": personal_loans},
                    run_log=os.path.join(root, "log"),
                    detail=lambda cat, run: detail.where(detail.rpt_dt == run.d),
                    detail_target=os.path.join(root, "detail"))
    assert job.execute() == {"PL_2": 3}
    led = {r.loan_num: r for r in read_ledger(spark, os.path.join(root, "ledger"), data_date=RUN.d8).collect()}
    assert led["DRW1"].od_type_js == "03" and led["DRW1"].loan_type_js == "经营"
    log = spark.read.parquet(os.path.join(root, "log"))
    assert log.where("step_desc = 'load detail' AND step_flag = 1").first().row_count == 2
    assert log.where("step_desc = 'load detail' AND step_flag = 0").count() == 1
