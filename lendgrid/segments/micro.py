"""XL_6: micro loans (one ledger row per voucher of the micro-loan system).

Driving table: micro-loan vouchers as of D with a positive amount and not
cancelled. Pre-aggregates per voucher / application (next schedule row,
earliest unpaid principal and interest, balances, entrusted payments,
prior voucher numbers, non-accrual counts, income this year) and the
guarantee classification are built first and left-joined on their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendgrid.functions import decode, norm_date
from lendgrid.operators import Lookup, attach_many, code_values, collect_concat, latest_by, lookup_unique
from lendgrid.rundate import RunDate
from lendgrid.segments.catalog import Catalog

# Source table names.
VOUCHER = "OMI.XL_AC_BUSINESSVCH_HS"
LOAN_MASTER = "OMI.XL_LN_MST_HS"
CONTRACT = "OMI.XL_AC_BUSINESSCONT_HS"
REPORT = "OMI.XL_BUS_DATA_REPORT_HS"
APP_VCH = "OMI.XL_APP_VCH_REL_HS"
ENTRUSTED = "OMI.XL_AC_TEPAYMENT_HS"
SCHEDULE = "OMI.XL_LN_SCHEDULE_HS"
WRITE_OFF = "OMI.XL_AC_VERIFI_INFO_HS"
CUSTOMER = "OMI.XL_CUST_INFO_HS"
ENTERPRISE = "OMI.XL_ENT_BASE_HS"
INDIVIDUAL = "OMI.XL_IND_BASE_HS"
CORE_ACCOUNT = "OMI.KN_KDPA_KEHUZH_HS"
ORG_PARAM = "OMI.KN_KBRP_JGCSHU_HS"
ACNO_MAP = "URDM.ACNO_INSTCODE_MAPPING"
OPTIONS = "OMI.XL_CN_SOPTLIST_HS"
DC_LOG = "OMI.XL_DC_LOG_HS"
COM_ITEM = "OMI.XL_COM_ITEM_HS"
SYS_PARAM = "OMI.XL_CN_SYSPARM_HS"
INT_STATUS = "OMI.XL_LN_INT_STATUS_HS"
LN_PARAM = "OMI.XL_LN_PARM_HS"
DC_ACC_REL = "OMI.XL_DC_ACC_REL_HS"
GCC_RELATIVE = "OMI.XL_BUS_GCC_RELATIVE_HS"
GUAR_CONTRACT = "OMI.XL_AC_GUARCONT_HS"
COLLATERAL = "OMI.XL_BUS_AFFRIM_COLLATERAL_HS"
GUAR_BASE = "OMI.XL_GUAR_BASE_HS"
CODE_MAP = "M_DICT_REMAPPING_DL"

# Codes and labels of the micro-loan system.
CANCELLED_VOUCHER = "20"
LEGACY_SOURCE = "LSXD"
OPEN_ACCOUNT_PREFIX = "CON"
INCOME_SUBJECT = "5001"
SYSDATE_PARAM = {"parcode": "0001", "stcd": "E", "parname": "sysdate"}
GREEN_PURPOSE_DICT = "XL-GRE_INDUSTRYTYPE_CBRC-GREEN_PURPOSE_CD"
MAP_BUSINESS_TYPE = "RSUM"
PURPOSE_OPTION = "loanPurpose"
REAL_ESTATE_COLLATERAL = ("0301", "0306")
KEPT_COLLATERAL = ("0301", "0306", "0404")
ACCT_STS_DESC = {"6": "核销", "9": "撤销"}
DRAWDOWN_TYPE_DESC = {"03": "借新还旧", "06": "续贷", "07": "重组"}
EARLY_LOAN_DESC = "历史早期贷款"
DRAWDOWN_TYPE_NEW = {"02": "展期", "03": "借新还旧", "04": "收回再贷", "05": "变更批复", "06": "续贷"}
REPAY_FREQ = {"1": "03", "3": "04", "4": "05", "5": "06"}
GRADE = {"0102": "1", "0202": "2", "0302": "3", "0402": "4", "0502": "5"}
LOAN_KIND = {"01": "1", "03": "3", "04": "2", "06": "99", "02": "91"}
MAIN_GUARANTY = {"10": "1", "20": "0", "30": "2", "50": "3"}
REPAY_TYP = {"1": "7", "2": "7", "3": "5", "4": "6", "5": "7", "6": "7", "7": "7", "8": "7"}
REPAY_TYP_DESC = {"1": "等额本息", "2": "等额本金", "5": "净息还款", "6": "自定义还款计划", "7": "弹性还款", "8": "气球贷"}
PRICING_BASE = {"0": "C", "1": "A0201", "2": "A0202", "3": "B02"}
PURPOSE_TEXT = {
    "101": "购进原材料", "102": "购进设备", "103": "加盟", "104": "开店", "105": "流动资金", "106": "营运周转",
    "107": "扩大经营", "108": "更换设备", "109": "进货", "111": "支付租金", "113": "囤货备货", "20": "小微经营",
    "19": "惠农通贷款", "10": "经营贷款", "16": "创业贷款", "21": "借新还旧", "22": "第四中支扶贫专项贷款",
    "23": "房抵经营", "27": "续贷", "28": "置换贷款", "18": "其他",
}
CONSTANTS = {
    "book_type": "1", "circle_loan_flg": "N", "departmentd": "xwdk", "fund_use_loc_cd": "I",
    "generalize_loan_flg": "Y", "gov_bondmorg_flg": "N", "internet_loan_flg": "N", "is_repay_options": "N",
    "loan_buy_int": "N", "loan_purpose_country_new": "CHN", "loan_sell_int": "N", "low_risk_flag": "N",
    "oversea_ann_loan_flag": "N", "pftz_loan_flg": "N", "security_amt": 0, "tax_related_flg": "N",
    "yangtze_river_loan_flg": "N", "int_adjest_amt": 0,
}


def _rename(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def _legacy_id(v: Column) -> Column:
    """Legacy voucher numbers (first character '1') are rewritten as the
    first 14 characters followed by '1'."""
    return F.when(F.substring(v, 1, 1) == "1", F.concat(F.substring(v, 1, 14), F.lit("1"))).otherwise(v)


def _org_names(cat: Catalog, run: RunDate) -> DataFrame:
    jg = cat.snapshot(ORG_PARAM, run)
    name = F.col("jigouzwm")
    for org, override in cat.choices.org_names.items():
        name = F.when(F.col("jigouhao") == org, F.lit(override)).otherwise(name)
    return jg.select("jigouhao", name.alias("jgmc"), "diqdaima")


def schedule_facts(cat: Catalog, run: RunDate) -> DataFrame:
    """Next schedule row after D (its interest) and earliest unpaid
    principal / interest due dates, one row per voucher."""
    s = cat.snapshot(SCHEDULE, run).withColumn("due", norm_date("rependdate"))
    nxt = latest_by(s.where(F.col("due") > F.lit(run.d)), ["vchno"],
                    [F.col("currcnt").asc_nulls_last(), F.col("due").asc_nulls_last()]).select(
        "vchno", F.col("currint").alias("ls1_currint"))
    unpaid = (F.col("lo_ind") == "1") & (F.col("repaystate") == "0")
    prcp = unpaid & ((F.col("curramt") - F.col("paysum")) > 0)
    intr = unpaid & ((F.col("currint") - F.col("payint") + F.col("over_int") - F.col("pay_over_int")) > 0)
    owed = s.groupBy("vchno").agg(F.min(F.when(prcp, F.col("due"))).alias("ls2_due"),
                                  F.min(F.when(intr, F.col("due"))).alias("ls3_due"))
    return nxt.join(owed, "vchno", "full")


def month_income(cat: Catalog, run: RunDate) -> DataFrame:
    """Income booked on subject 5001 since the start of the system year,
    per voucher. The system year comes from a one-row parameter table
    (uncorrelated scalar subquery; more than one row is an error)."""
    def dated(name: str) -> DataFrame:
        if "Q3" in cat.choices.literal:  # the bounds as the old job has them
            return cat.read(name).where((F.col("begndt") >= F.lit(run.d)) & (F.col("overdt") < F.lit(run.d)) & (F.col("partid") == run.partid))
        return cat.snapshot(name, run)

    p = dated(SYS_PARAM)
    for col, value in SYSDATE_PARAM.items():
        p = p.where(F.col(col) == value)
    year = F.substring("parvalue", 1, 4)
    year_start = p.select(norm_date(F.concat(year, F.lit("0101")))).scalar()
    log = dated(DC_LOG)
    items = dated(COM_ITEM).where(F.col("up_acc_hrt") == INCOME_SUBJECT).select(
        "acc_hrt", "bankid")
    booked = log.where(norm_date("tx_date") > year_start)
    if isinstance(log.schema["tx_date"].dataType, T.StringType):
        # no text of a later day sorts before its year (or begins with a space): a bound on the raw text, known when the scan starts
        first = p.select(F.min(year)).scalar()
        booked = booked.where((F.col("tx_date") >= first) | (F.col("tx_date") < F.lit("!")))
    booked = booked.join(items, ["acc_hrt", "bankid"])
    return booked.groupBy("vchno").agg(F.sum("amt").alias("bb_amt"))


def subject_codes(cat: Catalog, run: RunDate) -> DataFrame:
    """Subject account number per core product (a scalar lookup over a
    parameter -> relation -> item chain)."""
    aa = cat.snapshot(LN_PARAM, run).select("dc_code", "bankid", "prdt_no")
    b = cat.snapshot(DC_ACC_REL, run).where(F.col("dc_type") == "1").select("dc_code", "bankid", "acc_hrt")
    cc = cat.snapshot(COM_ITEM, run).select("acc_hrt", "acc_no")
    return aa.join(b, ["dc_code", "bankid"]).join(cc, "acc_hrt").select(
        F.col("prdt_no").alias("core_prdt_no"), F.col("acc_no").alias("item_acc_no"))


def guarantee_class(cat: Catalog, run: RunDate) -> DataFrame:
    """Guarantee class per voucher from contracts, guarantee contracts and
    collaterals. Voucher/guarantee combinations that span several collateral
    kinds keep only their real-estate (or 0404) rows."""
    t1 = cat.snapshot(VOUCHER, run).select("vchno", "cifid", "contno", "purpose")
    t2 = cat.snapshot(CONTRACT, run).select("contno", "applyno", "guar_type", "oth_guar_type")
    t3 = cat.snapshot(GCC_RELATIVE, run).select(F.col("contno").alias("r_contno"), F.col("applyno").alias("r_applyno"),
                                                "gccontno")
    t6 = cat.snapshot(GUAR_CONTRACT, run).select(F.col("contno").alias("gccontno"), "guarform")
    t4 = cat.snapshot(COLLATERAL, run).where(F.col("cifid").isNotNull()).select(
        F.col("applyno").alias("c_applyno"), "guar_no")
    t5 = cat.snapshot(GUAR_BASE, run).select("guar_no", "col_no")
    t2 = t2.withColumnRenamed("contno", "k_contno")
    rel = (t1.join(t2, F.col("contno") == F.col("k_contno"), "left")
           .join(t3, (F.col("k_contno") == F.col("r_contno")) & (F.col("r_applyno") == F.col("applyno")), "left")
           .join(t6, "gccontno", "left").join(t4, F.col("r_applyno") == F.col("c_applyno"), "left")
           .join(t5, "guar_no", "left"))
    g, o = F.col("guar_type"), F.col("oth_guar_type")
    col4 = F.substring("col_no", 1, 4)
    col4_or0 = F.substring(F.coalesce(F.col("col_no"), F.lit("0")), 1, 4)
    re_ = col4.isin(*REAL_ESTATE_COLLATERAL)
    not_re = ~col4_or0.isin(*REAL_ESTATE_COLLATERAL)
    dbfs = (F.when((g == "20") & o.isNull(), "A")
            .when((g == "50") & o.isNull(), "D")
            .when((g == "10") & o.isNotNull() & re_, "E01")
            .when(g.isNotNull() & o.isNotNull() & not_re, "E")
            .when((g == "10") & o.isNull() & re_, "B01")
            .when((g == "10") & o.isNull() & not_re, "B99")
            .when((g == "30") & o.isNull() & (F.col("guarform") == "30"), "C01")
            .when((g == "30") & o.isNull() & (F.col("guarform") != "30"), "C99")
            .when(re_, "E01")
            .otherwise("E"))
    rows = rel.select("vchno", "cifid", "guar_type", "oth_guar_type", "col_no", dbfs.alias("dbfs")).distinct()
    combos = ["vchno", "cifid", "guar_type", "oth_guar_type"]
    # Combinations with several kinds (no collateral is one of them) are told by windows over the distinct
    # rows, so the chain above is computed once.
    kinds = F.size(F.collect_set(F.coalesce(F.substring("col_no", 1, 4), F.lit("(none)"))).over(Window.partitionBy(*combos)))
    same = Window.partitionBy("vchno", "cifid", "guar_type", F.coalesce("oth_guar_type", F.lit("99999")))
    several = (F.max("kinds").over(same) > 1) & F.col("vchno").isNotNull() & F.col("cifid").isNotNull() & F.col("guar_type").isNotNull()
    judged = rows.withColumn("kinds", kinds).withColumn("several", several)
    kept = judged.where(~F.col("several") | F.substring("col_no", 1, 4).isin(*KEPT_COLLATERAL))
    purpose = decode("purpose", PURPOSE_TEXT)
    xl = t1.select("vchno", "cifid", purpose.alias("purpose_text")).join(
        kept.select("vchno", "cifid", "dbfs"), ["vchno", "cifid"], "left")
    return xl.select(F.col("vchno").alias("xl_vchno"), "purpose_text", F.col("dbfs").alias("xl_dbfs")).distinct()


def micro_loans(cat: Catalog, run: RunDate) -> DataFrame:
    a = cat.snapshot(VOUCHER, run).where((F.col("bus_sum") > 0) & (F.col("vch_sts") != CANCELLED_VOUCHER))
    b = _rename(cat.snapshot(LOAN_MASTER, run), "b", [
        "vchno", "ac_sts", "loss_bal", "in_lo_intst", "out_lo_intst", "over_bal", "next_rateadj_date"])
    c = _rename(cat.snapshot(CONTRACT, run), "c", ["contno", "applyno"])
    d = _rename(cat.snapshot(REPORT, run), "d", [
        "applyno", "school_loan_flag", "is_greloan_cbrc", "oc_prcp", "loan_target_field", "loan_target_field2",
        "first_loan_own", "industrytype", "jzfp_cust_type", "startupguauantee_flag", "gre_industrytype_cbrc"])
    rel = cat.snapshot(APP_VCH, run)
    avr = collect_concat(rel, ["applyno"], _legacy_id(F.col("vchno")), "|", "avr_org_vchno").withColumnRenamed(
        "applyno", "avr_applyno")
    dd = cat.snapshot(VOUCHER, run).groupBy(F.col("vchno").alias("dd_vchno")).agg(F.sum("bus_bal").alias("dd_bus_bal"))
    e = cat.snapshot(ENTRUSTED, run).groupBy(F.col("applyno").alias("e_applyno")).agg(F.sum("bus_sum").alias("e_bus_sum"))
    av = _rename(cat.snapshot(WRITE_OFF, run), "av", ["vchno", "occur_date"])
    g = _rename(cat.snapshot(CUSTOMER, run), "g", ["cifid", "outcifid", "cliname", "cstype"])
    eb = _rename(cat.snapshot(ENTERPRISE, run), "eb", ["cifid", "regioncode"])
    ib = _rename(cat.snapshot(INDIVIDUAL, run), "ib", ["cifid", "regioncode"])
    orgs = _org_names(cat, run)
    core = cat.snapshot(CORE_ACCOUNT, run).select("kehuzhao", "kaihjigo").join(
        orgs, F.col("kaihjigo") == F.col("jigouhao"), "left")
    kk = _rename(core, "kk", ["kehuzhao", "jgmc", "diqdaima"])
    kk1 = _rename(core, "kk1", ["kehuzhao", "jgmc"])
    acno = cat.read(ACNO_MAP).join(orgs, F.col("instcode") == F.col("jigouhao"), "left")
    kk4 = _rename(acno.where(F.col("acno_type") == "2").select("acno", "jgmc", "diqdaima").distinct(), "kk4",
                  ["acno", "jgmc", "diqdaima"])
    kk5 = _rename(acno.where(F.col("acno_type") == "1").select("acno", "jgmc", "diqdaima").distinct(), "kk5",
                  ["acno", "jgmc", "diqdaima"])
    xcs = _rename(cat.snapshot(OPTIONS, run).where(F.col("dccode") == PURPOSE_OPTION), "xcs", ["ddcode", "ddvalue"])
    cc = (cat.snapshot(INT_STATUS, run).where(F.col("status") == "1")
          .groupBy(F.col("vchno").alias("cc_vchno")).agg(F.count(F.lit(1)).alias("cc_con")))
    maps = cat.read(CODE_MAP).where(F.col("business_type") == MAP_BUSINESS_TYPE).withColumn(
        "ori_values", F.replace("ori_values", F.lit("%"), F.lit("")))

    # entry account: the repayment account for legacy vouchers without one
    entry_acct = F.when(F.col("depacc_no").isNull() & ~F.col("vchno").like(f"{OPEN_ACCOUNT_PREFIX}%"),
                        F.col("reppriac_no")).otherwise(F.col("depacc_no"))
    a = a.withColumn("entry_acct", entry_acct)
    # Chains are resolved on the narrow side (the contract's applications, the customer's
    # registries, the report's code), then all look-ups are attached together.
    sf = schedule_facts(cat, run).withColumnRenamed("vchno", "sf_vchno")
    mi = month_income(cat, run).withColumnRenamed("vchno", "mi_vchno")
    contract = c.join(avr, F.col("c_applyno") == F.col("avr_applyno"), "left").join(e, F.col("c_applyno") == F.col("e_applyno"), "left")
    customer = g.join(eb, F.col("eb_cifid") == F.col("g_cifid"), "left").join(ib, F.col("ib_cifid") == F.col("g_cifid"), "left")
    report = d.join(code_values(maps, GREEN_PURPOSE_DICT, "m1"), F.col("m1_key") == F.col("d_gre_industrytype_cbrc"), "left")
    voucher, entry, repay = ["vchno"], ["entry_acct"], ["reppriac_no"]
    j = attach_many(a, [
        Lookup(b, ["b_vchno"], voucher), Lookup(dd, ["dd_vchno"], voucher, unique=True), Lookup(sf, ["sf_vchno"], voucher),
        Lookup(av, ["av_vchno"], voucher), Lookup(mi, ["mi_vchno"], voucher, unique=True), Lookup(cc, ["cc_vchno"], voucher, unique=True),
        Lookup(guarantee_class(cat, run), ["xl_vchno"], voucher), Lookup(contract, ["c_contno"], ["contno"]),
        Lookup(report, ["d_applyno"], ["applyno"]), Lookup(customer, ["g_cifid"], ["cifid"]),
        Lookup(kk, ["kk_kehuzhao"], entry), Lookup(kk4, ["kk4_acno"], entry), Lookup(kk1, ["kk1_kehuzhao"], repay),
        Lookup(kk5, ["kk5_acno"], repay), Lookup(xcs, ["xcs_ddcode"], ["purpose"]),
    ], row_key=voucher, checks=cat.key_checks)
    j = lookup_unique(j, subject_codes(cat, run), ["core_prdt_no"], ["item_acc_no"], name="subject code")
    return j.select(*[expr.alias(name) for name, expr in _columns().items()])


def _columns() -> dict[str, Column]:
    sts, occ, pay = F.col("loan_sts"), F.col("occurtype"), F.col("pay_type")
    guar, prdt = F.col("guar_type"), F.col("prdt_no")
    not_special = ~occ.isin("03", "06", "07")
    first_own = F.col("d_first_loan_own")
    cols: dict[str, Column] = {
        "acct_num": F.col("contno"),
        "acct_sts": (F.when(sts == "1", "1").when(sts.isin("2", "3"), "2")
                     .when(~sts.isin("1", "2", "3", "6", "9"), "3").otherwise("9")),
        "acct_sts_desc": decode(sts, ACCT_STS_DESC),
        "acct_typ": F.when(prdt.like("%A%"), "010299").when(prdt.like("%B%"), "0202").otherwise("019999"),
        "accu_int_amt": F.coalesce(F.col("ls1_currint"), F.lit(0)),
        "accu_int_flg": F.when(F.col("cc_con") > 0, "N").otherwise("Y"),
        "actual_maturity_dt": norm_date(F.when(F.col("extenddate").isNull(), F.col("enddate"))
                                        .otherwise(F.col("extenddate"))),
        "base_int_rat": F.col("brate"),
        "campus_consu_loan_flg": decode("d_school_loan_flag", {"1": "1", "0": "2"}),
        "cancel_flg": F.when(F.col("b_ac_sts") == "6", "Y").otherwise("N"),
        "consecute_term_num": F.col("now_overdue_period"),
        "cumulate_term_num": F.col("overdue_period"),
        "current_term_num": F.col("now_period"),
        "curr_cd": F.col("curr"),
        "cust_id": F.coalesce("g_outcifid", "cifid"),
        "drawdown_amt": F.col("bus_sum"),
        "drawdown_base_int_rat": F.col("irate"),
        "drawdown_dt": norm_date("begindate"),
        "drawdown_real_int_rat": F.col("arate"),
        "drawdown_type": F.when((pay == "1") & not_special, "A").when((pay == "2") & not_special, "B").otherwise("Z"),
        "drawdown_type_desc": decode(occ, DRAWDOWN_TYPE_DESC).otherwise(F.when(pay.isNull(), EARLY_LOAN_DESC)),
        "drawdown_type_new": decode(occ, DRAWDOWN_TYPE_NEW),
        "emp_id": F.col("manage_operid"),
        "entrust_pay_amt": F.when(pay == "2", F.col("e_bus_sum")).otherwise(F.lit(0)),
        "extendterm_flg": F.when(F.col("ext_num") > 0, "Y").otherwise("N"),
        "finish_dt": norm_date(F.coalesce(F.col("finishdate"), F.col("av_occur_date"))),
        "float_type": F.when(F.col("base_rate_type") == "0", "A").otherwise("C"),
        "sp_prov_amt": F.col("b_loss_bal"),
        "green_balance": F.when(F.col("d_is_greloan_cbrc") == "1", F.col("dd_bus_bal")).otherwise(F.lit(0)),
        "green_loan_flg": decode("d_is_greloan_cbrc", {"1": "Y", "0": "N"}),
        "guaranty_typ": (F.when((guar == "10") & (prdt.like("A01%") | prdt.like("B04%")), "B01")
                         .when(guar == "10", "B99").when(guar == "20", "A").when(guar == "30", "C99")
                         .when(guar == "50", "D")),
        "independence_pay_amt": F.when(pay == "1", F.col("bus_sum")).otherwise(F.lit(0)),
        "indust_stg_type": F.col("d_oc_prcp"),
        "indust_tran_flg": F.when(F.col("d_loan_target_field") == "1", "1").otherwise("2"),
        "int_rate_typ": (F.when(F.col("float_mod") == "1", "F").when(F.col("rate_ftype").isin("1", "2"), "L5")
                         .when((F.col("rate_ftype") == "0") & (F.col("term_type") == "D"), "L0")
                         .when((F.col("rate_ftype") == "0") & (F.col("term_type") == "M"), "L2").otherwise("L9")),
        "int_repay_freq": decode("repay_freq", REPAY_FREQ, "07"),
        "is_first_loan_tag": decode(first_own, {"1": "1", "0": "2"}),
        "is_first_report_loan_tag": decode(first_own, {"1": "1", "0": "2"}),
        "item_cd": F.col("item_acc_no"),
        "i_od_dt": F.col("ls3_due"),
        "loans_to_culture_flag": F.when(F.col("d_loan_target_field2") == "1", "1").otherwise("2"),
        "loan_acct_bal": F.when(sts.isin("4", "6"), F.lit(0)).otherwise(F.col("bus_bal")),
        "loan_acct_bank": F.coalesce("kk_jgmc", "kk4_jgmc"),
        "loan_acct_name": F.coalesce("g_cliname", "depaccna"),
        "loan_acct_num": F.col("entry_acct"),
        "loan_business_typ": F.when(F.col("purpose") == "18", "9").otherwise("5"),
        "loan_fhz_num": F.col("contno"),
        "loan_grade_cd": F.trim(decode("clsfive", GRADE)),
        "loan_kind_cd": F.trim(decode(occ, LOAN_KIND)),
        "loan_num": F.when(F.col("data_source") == LEGACY_SOURCE,
                           F.concat(F.substring("vchno", 1, 14), F.lit("1"))).otherwise(F.col("vchno")),
        "loan_num_old": F.col("avr_org_vchno"),
        "loan_purpose_area": F.coalesce(
            F.when(F.col("g_cstype") == "C01", F.col("eb_regioncode")).when(F.col("g_cstype") == "A01", F.col("ib_regioncode")),
            F.col("kk_diqdaima"), F.col("kk4_diqdaima"), F.col("kk5_diqdaima")),
        "loan_purpose_cd": F.col("d_industrytype"),
        "loan_resched_dt": F.when(occ == "02", F.col("begndt")),
        "main_guaranty_typ": decode(guar, MAIN_GUARANTY),
        "maturity_dt": norm_date("enddate"),
        "next_int_pay_dt": norm_date("next_pay_int_date"),
        "od_days": F.coalesce(F.greatest("bal_overday", "int_overday"), F.lit(0)),
        "od_flg": F.when(F.col("lo_date").isNull(), "N").otherwise("Y"),
        "od_int": F.coalesce(F.col("b_in_lo_intst"), F.lit(0)),
        "od_int_obs": F.col("b_out_lo_intst"),
        "od_loan_acct_bal": F.col("b_over_bal"),
        "org_num": F.col("bal_instcode"),
        "orig_acct_no": F.col("org_vchno"),
        "orig_term": F.col("term"),
        "orig_term_type": F.col("term_type"),
        "pay_acct_bank": F.coalesce("kk1_jgmc", "kk5_jgmc"),
        "pay_acct_num": F.col("reppriac_no"),
        "poverty_alle": F.when(F.col("d_jzfp_cust_type") == "01", "Y").otherwise("N"),
        "ppl_repay_freq": decode("repay_freq", REPAY_FREQ),
        "p_od_dt": F.col("ls2_due"),
        "real_int_rat": F.col("arate"),
        "renew_flg": F.when(occ == "06", "Y").otherwise("N"),
        "repay_flg": F.when(occ == "03", "Y").otherwise("N"),
        "repay_term_num": F.col("period_all"),
        "repay_typ": decode("repay_type", REPAY_TYP),
        "repay_typ_desc": decode("repay_type", REPAY_TYP_DESC),
        "resched_flg": F.when(occ == "02", "Y").otherwise("N"),
        "transfers_loan_flg": decode("use_transfer_funds", {"1": "Y", "0": "N"}),
        "undertak_guar_type": F.when(F.col("d_startupguauantee_flag") == "1", "Z"),
        "useofunds": F.col("xcs_ddvalue"),
        "next_repricing_dt": norm_date(F.coalesce(F.col("b_next_rateadj_date"), F.col("enddate"))),
        "mon_int_incom": F.col("bb_amt"),
        "green_purpose_cd": F.col("m1_new_values"),
        "pricing_base_type": F.trim(decode("base_rate_type", PRICING_BASE, "")),
        "guaranty_typ_js": F.col("xl_dbfs"),
        "useofunds_js": decode("purpose", PURPOSE_TEXT),
    }
    for name, value in CONSTANTS.items():
        cols[name] = F.lit(value)
    return cols
