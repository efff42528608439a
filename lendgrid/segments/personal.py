"""PL_2: personal loans (one ledger row per drawn personal loan).

Driving table: personal loans as of D that were disbursed (not reversed or
unapplied) with a positive original principal; settled loans need a known
settlement date. Schedule-derived facts (current period, consecutive and
cumulative arrears counts, earliest unpaid principal / interest, overdue
balance, future interest) come from two aggregates over the repayment
schedule instead of one subquery each. The loan detail written earlier in
the run is read back for overdue type, loan state and loan group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendgrid.functions import case_map, decode, effective_rate, norm_date, substr1
from lendgrid.operators import Lookup, attach_many, code_values
from lendgrid.rundate import RunDate
from lendgrid.segments.catalog import Catalog, Choices
from lendgrid.sources import date_window

# Source table names.
LOAN = "OMI.PL_LOAN_HS"
ABS_DETAIL = "OMI.PL_ABS_LOAN_DETL_HS"
ACTV_LOG = "OMI.PL_LOAN_ACTV_LOG_HS"
LOAN_GRP = "OMI.PL_LS_LOAN_GRP_HS"
CUST = "OMI.PL_CUST_INFO_HS"
BRANCH = "OMI.PL_BCH_DEPT_HS"
BAD_DEBT = "OMI.PL_GAST_BAD_DEBT_HS"
SCHEDULE = "OMI.PL_PAYM_SCHED_HS"
LOAN_INFO = "OMI.PL_LOAN_INFO_HS"
LOAN_PARA = "OMI.PL_LOAN_PARA_HS"
APPL_TARGET = "OMI.PL_LS_APPL_LOAN_TARGET_HS"
APPL = "OMI.PL_LS_APPL_PPSL_HS"
CREDIT_LINE = "OMI.PL_CR_LN_HDR_HS"
USER = "OMI.PL_USR_PRFL_HS"
PERSON = "OMI.HR_BD_PSNDOC_HS"
GL_TX = "OMI.PL_GL_TX_HS"
DRAWDN = "OMI.PL_LS_APPL_DRAWDN_HS"
DRAWDN_DISB = "OMI.PL_LS_APPL_DRAWDN_DISB_HS"
AUTOPAY = "OMI.PL_ATPY_INSTR_HS"
GL_ASSIGN = "OMI.PL_GL_ASSGN_HS"
GL_ACCT = "OMI.PL_G_L_ACCT_NO_HS"
SUBJECT = "OMI.KN_KFAP_KJKEMU_HS"
ORG_PARAM = "OMI.KN_KBRP_JGCSHU_HS"
OD_INT_LOG = "OMI.PL_OD_INT_LOG_HS"
SETTLE_LOG = "OMI.PL_SETLMT_LOG_HS"
GUARANTEE = "URDM.SJBS_DKDBFS_LS"
GUARANTEE_JS = "URDM.DKDBFS_LS_JS"
LOAN_TARGET = "OMI.PL_LOAN_TARGET_HS"
TERM = "OMI.PL_LOAN_SCHD_TERM_HS"
RESTRUCTURE = "OMI.PL_RSTR_LOG_HS"
DETAIL = "URDM.PL_LBI_R_LOAN_DETAIL_HS"
CODE_MAP = "M_DICT_REMAPPING_DL"

# Codes and labels of the personal-loan system.
ACTIVE, SETTLED = "ACTV", "SETL"
NORMAL_DEBT, CHARGED_OFF = "NORM", "CHRGO"
NOT_DRAWN = ("REVS", "NBAP")
GL_FUNC, GL_SEQ = "LNLNACTF", "3"
TARGET_TU, TARGET_TC = "TU", "TC"
RESTRUCTURE_TYPE = "TN"
USEOFUNDS_DICT, GREEN_TYPE_DICT, GREEN_PURPOSE_DICT = (
    "PL-PRPS_FIN-GENERAL_RESERVE", "CL-CUST_REF-CAMPUS_CONSU_LOAN_FLG", "PL-ENDOWMENT_INS_NO-GREEN_PURPOSE_CD")
MAP_BUSINESS_TYPE = "RSUM"
USEOFUNDS_OTHER = "其他贷款"
AREA_REWRITE = {"460400": "000000"}
GRADE = {"100": "1", "200": "2", "300": "3", "400": "4", "500": "5"}
MAIN_GUARANTY = {"BCOLL": "0", "COLL": "1", "GUAR": "2", "CREDIT": "3"}
HOUSING, HOUSING_TYPES, COMMERCIAL_TYPES = "个人住房贷款", ("1010", "1020"), ("1030", "1040", "1050", "1060")
STUDENT_PURPOSE, CAR_PURPOSE = "07", "05"
GROUP_ACCT_TYP = {
    "个人质押贷款": "010399", "个人消费贷款": "010399", "个人经营贷款": "010299", "个人授信额度": "010399",
    "个人政策性贷款": "010399", "个人委托贷款": "90", "个人其他贷款": "010399", "联保体授信额度": "010399",
}
GROUP_ACCT_DESC = {
    "个人质押贷款": "个人质押贷款", "个人授信额度": "个人授信额度", "个人政策性贷款": "政策性贷款",
    "个人其他贷款": "个人其他贷款", "联保体授信额度": "联保体授信额度",
}
OTHER_HOUSING_DESC = "其他个人住房贷款"
MONTHLY_REPAY_TYP = {1: "1", 3: "2", 6: "3", 12: "4"}
MONTHLY_INT_FREQ = {1: "03", 3: "04", 6: "05", 12: "06"}
WEEKLY_DESC = {1: "按周", 2: "按双周"}
IRREGULAR_DESC, BIWEEKLY_INT_DESC, OTHER_INT_DESC = "还款", "按双周结息", "其他结息"
FIX_REPRICING = {"MONTH": "L2", "THREEMONTH": "L3", "SIXMONTH": "L4", "YEAR": "L5"}
NNR_MONTHLY = {1: "L2", 3: "L3", 6: "L4", 12: "L5"}
CONSTANTS = {
    "accu_int_flg": "Y", "book_type": "2", "campus_consu_loan_flg": "N", "curr_cd": "CNY", "departmentd": "grdk",
    "extendterm_flg": "N", "fund_use_loc_cd": "I", "generalize_loan_flg": "N", "gov_bondmorg_flg": "N",
    "internet_loan_flg": "N", "in_drawdown_dt": None, "is_first_report_loan_tag": "N", "loan_business_typ": "4",
    "loan_buy_int": "N", "loan_purpose_country_new": "CHN", "low_risk_flag": "N", "year_int_incom": "0",
    "orig_term_type": "M", "resched_flg": "N", "tax_related_flg": "N", "transfers_loan_flg": "N",
    "int_adjest_amt": 0,
}


def _rename(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def _org_name(c: Column, rewrites: Mapping[str, str]) -> Column:
    """The name to show (the source rewrites its head-office name to the legal entity's)."""
    out = c
    for src, dst in rewrites.items():
        out = F.when(c == src, F.lit(dst)).otherwise(out)
    return out


def schedule_facts(cat: Catalog, run: RunDate, loans: DataFrame) -> DataFrame:
    """Per loan number, from the schedule joined to the loans (as the source
    subqueries do): current period, arrears counts, earliest unpaid dates,
    overdue principal balance."""
    d = F.lit(run.d)
    s = cat.snapshot(SCHEDULE, run).withColumn("due", norm_date("due_dt"))
    oil = cat.snapshot(OD_INT_LOG, run)
    by_period = oil.groupBy(F.col("loan_typ").alias("loan_lnpa_loan_typ"), F.col("loan_no").alias("loan_loan_no"),
                            "perd_no").agg(
        (F.sum("int_amt") - F.sum("setl_int") - F.sum(F.coalesce(F.col("wv_int"), F.lit(0)))).alias("oi_net"))
    any_row = oil.groupBy(F.col("loan_no").alias("loan_loan_no"), "perd_no").agg(
        F.max(F.when((F.col("int_amt") - F.col("setl_int") - F.col("wv_int")) > 0, F.lit(1))).alias("oi_row_due"))
    a = loans.select(F.col("loan_no").alias("loan_loan_no"), norm_date("next_due_dt").alias("a_next_due"))
    j = (s.join(a, "loan_loan_no").join(by_period, ["loan_lnpa_loan_typ", "loan_loan_no", "perd_no"], "left")
         .join(any_row, ["loan_loan_no", "perd_no"], "left"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    past = F.col("due") <= d
    int_due = ((z("int_amt") - z("setl_int")) > 0) | (F.col("oi_row_due") == 1)
    arrears = (F.col("perd_no") > 0) & past & (
        (((F.col("int_amt") - F.col("setl_int")) + (F.col("prcp_amt") - F.col("setl_prcp"))) > 0)
        | (F.col("oi_net") > 0)
        | (F.col("due") < F.coalesce(norm_date("last_setl_dt"), d)))
    return j.groupBy(F.col("loan_loan_no").alias("loan_no")).agg(
        F.min(F.when(F.col("due") > d, F.col("perd_no"))).alias("dqqs"),
        F.count(F.when(past & (F.col("due") >= F.col("a_next_due")), F.lit(1))).alias("tmp3_count"),
        F.count(F.when(arrears, F.lit(1))).alias("tmp4_count"),
        F.min(F.when(past & ((F.col("prcp_amt") - F.col("setl_prcp")) > 0), F.col("due"))).alias("s9_due"),
        F.min(F.when(past & int_due, F.col("due"))).alias("s10_due"),
        F.sum(F.when(past, F.when(F.col("a_next_due") <= d, z("prcp_amt") - z("setl_prcp")).otherwise(F.lit(0))))
        .alias("s13_yqdkye"),
    )


def future_interest(cat: Catalog, run: RunDate) -> DataFrame:
    s = cat.snapshot(SCHEDULE, run).where(norm_date("due_dt") > F.lit(run.d))
    return s.groupBy(F.col("loan_loan_no").alias("loan_no")).agg(F.sum("int_amt").alias("ps_int_amt"))


def _read_detail(cat: Catalog, run: RunDate) -> DataFrame:
    det = cat.read(DETAIL).where(F.col("rpt_dt") == F.lit(run.d))
    return _rename(det, "r1", ["loan_no", "last_due_dt", "loan_grd", "od_prcp_amt", "od_int_amt", "od_od_int_amt",
                               "loan_grp2"])


def personal_loans(cat: Catalog, run: RunDate) -> DataFrame:
    d = F.lit(run.d)
    a = cat.snapshot(LOAN, run)
    loan_abs = _rename(cat.snapshot(ABS_DETAIL, run), "abs", ["loan_no", "abs_seq", "sale_dt"])
    e = _rename(cat.snapshot(ACTV_LOG, run), "e", ["loan_no", "loan_drawdn_no"])
    g = _rename(cat.snapshot(LOAN_GRP, run), "g", ["loan_grp_code", "loan_grp_pri_desc"])
    cust = _rename(cat.snapshot(CUST, run), "d", ["id_no", "id_type", "iss_ctry", "cust_no"])
    branches = cat.snapshot(BRANCH, run)
    b = _rename(branches, "b", ["bch_cde", "dist_cde", "corebank_bch"])
    gb = _rename(cat.snapshot(BAD_DEBT, run), "gb", ["loan_no", "last_appr_dt"])
    li = _rename(cat.snapshot(LOAN_INFO, run), "li", [
        "loan_no", "int_recvl_amt", "odi_recvl_amt", "int_susp_recvl_amt", "int_ndv_recvl_amt", "odi_susp_recvl_amt",
        "odi_ndv_recvl_amt"])
    lp = _rename(cat.snapshot(LOAN_PARA, run), "lp", ["loan_typ", "instm_ln_ind", "irreg_ind"])
    # one pass over the target fields, a column for each one that is asked for
    field = F.col("appl_loan_target_field")
    lalt = (cat.snapshot(APPL_TARGET, run).where(field.isin(TARGET_TU, TARGET_TC))
            .groupBy(F.col("ls_appl_seq").alias("lalt_ls_appl_seq"))
            .agg(F.max(F.when(field == TARGET_TU, field)).alias("lalt1_appl_loan_target_field"),
                 F.max(F.when(field == TARGET_TC, field)).alias("lalt2_appl_loan_target_field")))
    f = _rename(cat.snapshot(APPL, run), "f", ["ls_appl_seq", "appl_ppsl_pay_way"])
    ww = _rename(cat.snapshot(CREDIT_LINE, run), "ww",
                 ["ctif_id_type", "ctif_id_no", "ctif_iss_ctry", "cr_line", "revv_ind"])
    u = _rename(cat.snapshot(USER, run), "u", ["usr_id", "ctif_id_no"])
    bp = _rename(cat.snapshot(PERSON, run), "bp", ["id", "code"])
    gt = (cat.read(GL_TX).where((F.col("func_id") == GL_FUNC) & (F.col("seq_no") == GL_SEQ))
          .select(F.col("gl_ac_no").alias("gt_gl_ac_no"), F.col("loan_no").alias("gt_loan_no")).distinct())
    r = (cat.snapshot(DRAWDN, run).groupBy(F.col("ls_appl_seq").alias("r_ls_appl_seq"))
         .agg(F.max("ls_appl_drawdn_seq").alias("r_ls_appl_drawdn_seq")))
    l_disb = _rename(cat.snapshot(DRAWDN_DISB, run).select(
        "ls_appl_drawdn_seq", "appl_drawdn_disb_ref", "appl_drawdn_disb_name", "appl_drawdn_disb_ac_bch").distinct(),
        "l", ["ls_appl_drawdn_seq", "appl_drawdn_disb_ref", "appl_drawdn_disb_name", "appl_drawdn_disb_ac_bch"])
    z = _rename(cat.snapshot(AUTOPAY, run).select("loan_loan_no", "acct_no", "bkbh_bank_bch_cde", "name").distinct(),
                "z", ["loan_loan_no", "acct_no", "bkbh_bank_bch_cde", "name"])
    gl = cat.snapshot(GL_ACCT, run).select("ldgr_cde", "gl_ac_no")
    km = cat.snapshot(SUBJECT, run).select(F.col("kemuhaoo").alias("gl_ac_no"), "kemumnch")
    ga = (cat.snapshot(GL_ASSIGN, run).select("ai_recvl_gl", "lnpa_loan_typ")
          .join(gl, F.col("ai_recvl_gl") == F.col("ldgr_cde"), "left").join(km, "gl_ac_no", "left")
          .select(F.col("gl_ac_no").alias("ga_gl_ac_no"), F.col("lnpa_loan_typ").alias("ga_lnpa_loan_typ")))
    s11 = (cat.snapshot(SCHEDULE, run).where(F.col("perd_no") == 0)
           .select(F.col("loan_loan_no").alias("s11_loan_no"), F.col("int_rate").alias("s11_int_rate")))
    s12 = (cat.snapshot(SETTLE_LOG, run).groupBy(F.col("loan_no").alias("s12_loan_no"))
           .agg(F.max("val_dt").alias("s12_val_dt")))
    c = _rename(cat.read(GUARANTEE), "c", ["loan_no", "l_type"])
    cjs = _rename(cat.read(GUARANTEE_JS), "cjs", ["loan_no", "l_type"])
    lt = _rename(cat.snapshot(LOAN_TARGET, run), "lt", ["code", "weight_code"])
    st = (cat.snapshot(TERM, run).where(F.col("repaym_opt") == "IO")
          .select(F.col("loan_no").alias("st_loan_no")).distinct())
    rll = (date_window(cat.read(RESTRUCTURE).where(F.col("rstr_typ") == RESTRUCTURE_TYPE), "create_dt", run.month_start, run.d)
           .groupBy(F.col("loan_no").alias("rll_loan_no")).agg(F.count(F.lit(1)).alias("rll_cnt")))
    maps = cat.read(CODE_MAP).where(F.col("business_type") == MAP_BUSINESS_TYPE)

    # Chains are resolved on the narrow side first (an officer's person, the branch and
    # organisation of an account), so that every look-up is keyed by the driving row and
    # all are attached together.
    branch_org = branches.select("bch_cde", "corebank_bch").join(
        cat.snapshot(ORG_PARAM, run).select("jigouhao", "jigouzwm"), F.col("corebank_bch") == F.col("jigouhao"), "left")

    def at_branch(rows: DataFrame, column: str, branch: str, org: str) -> DataFrame:
        named = branch_org.select(F.col("bch_cde").alias(f"{branch}_bch_cde"), F.col("corebank_bch").alias(f"{branch}_corebank_bch"),
                                  F.col("jigouhao").alias(f"{org}_jigouhao"), F.col("jigouzwm").alias(f"{org}_jigouzwm"))
        return rows.join(named, F.col(column) == F.col(f"{branch}_bch_cde"), "left")

    drawn = at_branch(r.join(l_disb, F.col("r_ls_appl_drawdn_seq") == F.col("l_ls_appl_drawdn_seq"), "left"), "l_appl_drawdn_disb_ac_bch", "lbd", "kj")
    autopay = at_branch(z, "z_bkbh_bank_bch_cde", "lbd1", "kj1")
    officer = u.join(bp, F.col("bp_id") == F.col("u_ctif_id_no"), "left")
    m3 = maps.withColumn("ori_values", F.replace("ori_values", F.lit("%"), F.lit("")))
    loan, application, loan_type = ["loan_no"], ["ls_appl_seq"], ["lnpa_loan_typ"]
    j = attach_many(a, [
        Lookup(e, ["e_loan_no"], loan), Lookup(gb, ["gb_loan_no"], loan),
        Lookup(future_interest(cat, run).withColumnRenamed("loan_no", "ps_loan_no"), ["ps_loan_no"], loan, unique=True),
        Lookup(li, ["li_loan_no"], loan), Lookup(gt, ["gt_loan_no"], loan), Lookup(autopay, ["z_loan_loan_no"], loan),
        Lookup(schedule_facts(cat, run, a).withColumnRenamed("loan_no", "sf_loan_no"), ["sf_loan_no"], loan, unique=True),
        Lookup(s11, ["s11_loan_no"], loan), Lookup(s12, ["s12_loan_no"], loan, unique=True), Lookup(c, ["c_loan_no"], loan),
        Lookup(cjs, ["cjs_loan_no"], loan), Lookup(st, ["st_loan_no"], loan, unique=True),
        Lookup(_read_detail(cat, run), ["r1_loan_no"], loan), Lookup(rll, ["rll_loan_no"], loan, unique=True),
        Lookup(loan_abs, ["abs_loan_no", "abs_abs_seq"], ["loan_no", "abs_seq"]),
        Lookup(lalt, ["lalt_ls_appl_seq"], application, unique=True), Lookup(f, ["f_ls_appl_seq"], application),
        Lookup(drawn, ["r_ls_appl_seq"], application),
        Lookup(cust, ["d_id_no", "d_id_type", "d_iss_ctry"], ["ctif_id_no", "ctif_id_type", "ctif_iss_ctry"]),
        Lookup(ww, ["ww_ctif_id_type", "ww_ctif_id_no", "ww_ctif_iss_ctry", "ww_cr_line"], ["ctif_id_type", "ctif_id_no", "ctif_iss_ctry", "cr_line"]),
        Lookup(officer, ["u_usr_id"], ["aofr_acct_offcr_cde"]), Lookup(g, ["g_loan_grp_code"], [substr1("lnpa_loan_typ", 2)]),
        Lookup(lp, ["lp_loan_typ"], loan_type), Lookup(ga, ["ga_lnpa_loan_typ"], loan_type), Lookup(lt, ["lt_code"], ["loan_target"]),
        Lookup(b, ["b_bch_cde"], ["bhdt_bch_cde"]),
        Lookup(code_values(maps, USEOFUNDS_DICT, "m"), ["m_key"], ["prps_fin"]),
        Lookup(code_values(maps, GREEN_TYPE_DICT, "m1"), ["m1_key"], ["cust_ref"]),
        Lookup(code_values(m3, GREEN_PURPOSE_DICT, "m3"), ["m3_key"], ["endowment_ins_no"]),
    ], row_key=loan, checks=cat.key_checks)

    sts, debt = F.col("sts"), F.col("debt_sts")
    finish = (F.when((sts == SETTLED) & (debt == NORMAL_DEBT), norm_date(F.coalesce("s12_val_dt", "last_setl_dt")))
              .when((sts == SETTLED) & (debt == CHARGED_OFF), norm_date("gb_last_appr_dt")))
    keep = (~sts.isin(*NOT_DRAWN) & ((sts != SETTLED) | ((sts == SETTLED) & finish.isNotNull()))
            & (F.col("orig_prcp") > 0))
    columns = _columns(run, finish, cat.choices)
    if "Q4" in cat.choices.literal:
        columns["mon_int_incom"] = columns.pop("year_int_incom")
    return j.where(keep).select(*[expr.alias(name) for name, expr in columns.items()])


def _acct_typ(with_commercial: bool) -> Column:
    typ4 = substr1("lnpa_loan_typ", 4)
    grp = F.col("g_loan_grp_pri_desc")
    rules = [(F.col("prps_fin") == STUDENT_PURPOSE, "0104"),
             (typ4.isin(*HOUSING_TYPES) & (grp == HOUSING), "010101")]
    if with_commercial:
        rules.append((typ4.isin(*COMMERCIAL_TYPES), "010201"))
    rules += [(~typ4.isin(*HOUSING_TYPES) & (grp == HOUSING), "010199"),
              (F.col("prps_fin") == CAR_PURPOSE, "010301")]
    rules += [(grp == k, v) for k, v in GROUP_ACCT_TYP.items()]
    return F.trim(case_map(rules, "010399"))


def _columns(run: RunDate, finish: Column, choices: Choices) -> dict[str, Column]:
    d = F.lit(run.d)
    sts, debt = F.col("sts"), F.col("debt_sts")
    next_due = norm_date("next_due_dt")
    pay_way = F.col("f_appl_ppsl_pay_way")
    typ135 = F.col("lnpa_loan_typ").like("135%")
    unit, num = F.col("instm_freq_unit_typ"), F.col("instm_freq_num_unit").try_cast("int")
    monthly = lambda n: (unit == "M") & (num == n)
    instm = F.col("lp_instm_ln_ind")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    last_due = F.coalesce(F.col("r1_last_due_dt"), F.col("last_due_dt"))
    repc = norm_date(F.coalesce(F.col("next_repc_dt"), last_due))
    rate_mode, option = F.col("rate_mode"), F.col("next_repc_option")
    rv = rate_mode == "RV"
    int_rate_rules = [(rate_mode == "FX", "F"), (rv & option.isin("NYF", "DDA"), "L5")]
    int_rate_rules += [(rv & (option == "FIX") & (F.col("next_repc_num") == k), v) for k, v in FIX_REPRICING.items()]
    int_rate_rules += [(rv & (option == "NNR") & (unit == "W") & (num == 1), "L1")]
    int_rate_rules += [(rv & (option == "NNR") & monthly(n), v) for n, v in NNR_MONTHLY.items()]
    od_prcp = z("r1_od_prcp_amt")
    od_int = z("r1_od_int_amt") + z("r1_od_od_int_amt")
    cols: dict[str, Column] = {
        "acct_num": F.col("loan_no"),
        "acct_sts": F.when((sts == ACTIVE) & (next_due < d), "2").when(sts == ACTIVE, "1")
                     .when((sts == SETTLED) & (debt == NORMAL_DEBT), "3"),
        "accu_int_amt": z("ps_int_amt"),
        "actual_maturity_dt": norm_date("last_due_dt"),
        "base_int_rat": F.replace(F.col("base_rate").cast("string"), F.lit("%"), F.lit("")),
        "cancel_flg": F.when((sts == SETTLED) & (debt == CHARGED_OFF), "Y").otherwise("N"),
        "circle_loan_flg": F.coalesce(F.col("ww_revv_ind"), F.lit("N")),
        "consecute_term_num": z("tmp3_count"),
        "consume_loan_add_type": F.when(F.col("prps_fin").isin("09", "14"), "A").otherwise(""),
        "cumulate_term_num": F.greatest(z("tmp4_count"), z("tmp3_count")),
        "current_term_num": z("dqqs"),
        "cust_id": F.when(F.length("d_cust_no") == 1, F.col("d_id_no")).otherwise(F.col("d_cust_no")),
        "drawdown_amt": F.col("orig_prcp"),
        "drawdown_base_int_rat": F.col("base_rate") + F.col("sprd"),
        "drawdown_dt": norm_date("actv_dt"),
        "drawdown_real_int_rat": F.col("s11_int_rate"),
        "drawdown_type": F.when(pay_way == "ST", "B").when(pay_way == "ZZ", "A").when(typ135, "A").otherwise("B"),
        "emp_id": F.when(F.length("aofr_acct_offcr_cde") == 6, F.col("aofr_acct_offcr_cde")).otherwise(F.col("bp_code")),
        "entrust_pay_amt": F.when(pay_way == "ST", F.col("orig_prcp"))
                            .when((pay_way != "ZZ") & ~typ135, F.col("orig_prcp")),
        "finish_dt": F.when(F.col("sale_ind") == "Y", norm_date("abs_sale_dt")).otherwise(finish),
        "float_type": F.when(F.col("cis_sts") == "LPR", "A").otherwise("B"),
        "green_balance": F.when(F.col("endowment_ins_no").isNotNull() & (sts != SETTLED) & (debt != CHARGED_OFF),
                                F.col("os_prcp")),
        "green_loan_flg": F.coalesce(F.col("recourse"), F.lit("N")),
        "green_loan_type": F.col("m1_new_values"),
        "green_purpose_cd": F.col("m3_new_values"),
        "independence_pay_amt": F.when((pay_way == "ZZ") | typ135, F.col("orig_prcp")),
        "indust_tran_flg": F.when(F.col("lalt1_appl_loan_target_field") == TARGET_TU, "1").otherwise("2"),
        "is_repay_options": F.when(F.col("lnpa_loan_typ").like("10%")
                                   & (F.add_months(norm_date("actv_dt"), 12) < d), "N").otherwise("Y"),
        "item_cd": F.col("ga_gl_ac_no"),
        "i_od_dt": F.col("s10_due"),
        "loans_to_culture_flag": F.when(F.col("lalt2_appl_loan_target_field") == TARGET_TC, "Y").otherwise("N"),
        "loan_acct_bal": F.when((sts == SETTLED) & (debt == CHARGED_OFF), F.lit(0)).otherwise(F.col("os_prcp")),
        "loan_acct_bank": _org_name(F.coalesce("kj_jigouzwm", "kj1_jigouzwm"), choices.org_rewrites),
        "loan_acct_name": F.coalesce("l_appl_drawdn_disb_name", "z_name"),
        "loan_acct_num": F.coalesce("l_appl_drawdn_disb_ref", "gt_gl_ac_no", "z_acct_no"),
        "loan_fhz_num": F.col("loan_no"),
        "loan_grade_cd": F.trim(F.when(F.col("loan_grd").isNull(), "1").otherwise(decode("loan_grd", GRADE))),
        "loan_num": F.col("e_loan_drawdn_no"),
        "loan_num_old": F.col("refinc_furchrg_no"),
        "loan_purpose_area": decode("b_dist_cde", AREA_REWRITE, F.col("b_dist_cde")),
        "loan_purpose_cd": F.concat(F.substring("lt_weight_code", 5, 1), F.col("lt_code")),
        "loan_sell_int": F.col("sale_ind"),
        "main_guaranty_typ": decode("main_gur_typ", MAIN_GUARANTY),
        "maturity_dt": norm_date("last_due_dt"),
        "next_int_pay_dt": F.when(next_due > d, next_due),
        "next_repricing_dt": F.when(rate_mode == "FX", norm_date(last_due))
                              .otherwise(F.when(norm_date(last_due) < repc, norm_date(last_due))
                                         .otherwise(F.coalesce(norm_date("next_repc_dt"), norm_date(last_due)))),
        "od_days": F.datediff(d, next_due),
        "od_flg": F.when(next_due < d, "Y").otherwise("N"),
        "od_int": z("li_int_recvl_amt") + z("li_odi_recvl_amt") + z("adj_bf_prcp"),
        "od_int_obs": (z("li_int_susp_recvl_amt") + z("li_int_ndv_recvl_amt") + z("li_odi_susp_recvl_amt")
                       + z("li_odi_ndv_recvl_amt")),
        "od_loan_acct_bal": F.when(F.col("sale_ind") == "Y", F.lit(0)).otherwise(F.col("s13_yqdkye")),
        "org_num": F.col("b_corebank_bch"),
        "orig_term": F.col("loan_tnr"),
        "pay_acct_bank": _org_name(F.coalesce("kj1_jigouzwm", "kj_jigouzwm"), choices.org_rewrites),
        "pay_acct_num": F.col("z_acct_no"),
        "pricing_base_type": F.trim(F.when(F.col("cis_sts") == "LPR", "C")
                                    .when(F.coalesce(F.col("cis_sts"), F.lit("BIR")) == "BIR", "B02").otherwise("Z99")),
        "p_od_dt": F.col("s9_due"),
        "real_int_rat": effective_rate("base_rate", "sprd", "int_adj_pct"),
        "renew_flg": F.when(F.col("refinc_furchrg_ind") == "E", "Y").otherwise("N"),
        "repay_flg": F.when(F.col("refinc_furchrg_ind") == "R", "Y").otherwise("N"),
        "repay_term_num": F.col("tnr"),
        "useofunds": F.coalesce(F.col("m_new_values"), F.lit(USEOFUNDS_OTHER)),
        "acct_typ": _acct_typ(with_commercial=False),
        "acct_typ_desc": F.trim(case_map(
            [(F.col("g_loan_grp_pri_desc") == k, v) for k, v in GROUP_ACCT_DESC.items()]
            + [(~substr1("lnpa_loan_typ", 4).isin(*HOUSING_TYPES) & (F.col("g_loan_grp_pri_desc") == HOUSING),
                OTHER_HOUSING_DESC)], "")),
        "repay_typ": F.when((instm == "N") & F.col("st_loan_no").isNotNull(), "5")
                      .when(instm == "Y", case_map([(monthly(n), v) for n, v in MONTHLY_REPAY_TYP.items()], "7"))
                      .otherwise("7"),
        "repay_typ_desc": case_map([((unit == "W") & (num == n), v) for n, v in WEEKLY_DESC.items()]
                                   + [((instm == "Y") & (unit == "M") & ~num.isin(1, 3, 6, 12), IRREGULAR_DESC)]),
        "int_rate_typ": case_map(int_rate_rules, "L9"),
        "int_repay_freq": case_map([((instm == "N") & F.col("st_loan_no").isNull(), "07")]
                                   + [(monthly(n), v) for n, v in MONTHLY_INT_FREQ.items()]
                                   + [((unit == "W") & (num == 1), "02")], "99"),
        "int_repay_freq_desc": case_map([((num == 2) & (unit == "W"), BIWEEKLY_INT_DESC),
                                         (F.coalesce(F.col("lp_irreg_ind"), F.lit("N")) == "N", ""),
                                         ((unit == "M") & num.isin(1, 3, 6, 12), ""),
                                         ((unit == "W") & (num == 1), "")], OTHER_INT_DESC),
        # only 'TC' rows are joined here, so the strategic-industry digits never
        # match and the value is always 'N' (kept as the source computes it)
        "indust_stg_type": decode("lalt2_appl_loan_target_field", {str(i): str(i) for i in range(1, 8)}, "N"),
        "guaranty_typ": F.col("c_l_type"),
        "acct_typ_js": _acct_typ(with_commercial=True),
        "guaranty_typ_js": F.col("cjs_l_type"),
        "od_type_js": F.when(F.col("r1_loan_grd") == "100", "")
                       .when((od_prcp > 0) & (od_int > 0), "03").when(od_prcp > 0, "01").when(od_int > 0, "02")
                       .otherwise(""),
        "loan_status_js": F.when(F.col("r1_loan_grd") == "100",
                                 F.when(F.col("rll_cnt") > 0, "LS04").otherwise("LS01")).otherwise("LS03"),
        "loan_type_js": F.col("r1_loan_grp2"),
    }
    for name, value in CONSTANTS.items():
        cols[name] = F.lit(value)
    return cols
