"""CL_1: corporate credit (one ledger row per corporate duebill).

Driving table: corporate duebills as of D (loan business types, excluding
bill financing, plus entrusted loans). The contract, putout, customer,
core-banking account, repayment and interest-setting records, trade-finance
settlement parties and org registries are left-joined on their keys; the
guarantee class, arrears counts, year-to-date interest, customer balances
and internal-account registries are pre-aggregated first. Joins that cannot
change a value in the source (a second account lookup, the prior-period
ledger read, an unused registry union) are not reproduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendgrid.functions import case_map, concat_null_as_empty, decode, norm_date, rate_text, term_months, text_after
from lendgrid.operators import Lookup, attach_many, code_values, latest_by, lookup_unique
from lendgrid.rundate import RunDate
from lendgrid.segments.catalog import Catalog
from lendgrid.segments.codes import CULTURE_INDUSTRIES, UPGRADE_INDUSTRIES
from lendgrid.sources import date_window, dated_dim, partition_only

# Source table names.
DUEBILL = "OMI.CL_BUSINESS_DUEBILL_HS"
ADVANCED = "OMI.CL_ADVANCED_INFO_HS"
CONTRACT = "OMI.CL_BUSINESS_CONTRACT_HS"
ACCEPT = "OMI.BS_ACCEPT_DETAILS_VIEW_HS"
CUSTOMER = "OMI.CL_CUSTOMER_INFO_HS"
CODE_LIB = "OMI.CL_CODE_LIBRARY_HS"
BUS_TYPE = "OMI.CL_BUSINESS_TYPE_HS"
ENTERPRISE = "OMI.CL_ENT_INFO_HS"
PUTOUT = "OMI.CL_BUSINESS_PUTOUT_HS"
CONTRACT_REL = "OMI.CL_CONTRACT_RELATIVE_HS"
GUARANTY = "OMI.CL_GUARANTY_CONTRACT_HS"
REPAY_ATTR = "OMI.KN_KLNB_DKHKSX_HS"
ACCOUNT_MAIN = "OMI.KN_KLNA_DKZHZB_HS"
PRODUCT_CFG = "OMI.KN_KFAP_YEWUPZ_HS"
PRODUCT_ATTR = "OMI.KN_KFAP_YESHUX_HS"
RATE_ATTR = "OMI.KN_KLNB_DKJXSX_HS"
DISB_ATTR = "OMI.KN_KLNB_DKFKSX_HS"
INTERNAL_ACCT = "OMI.KN_KTAA_NBFHZH_HS"
ORG_BRANCH = "L_PUBL_ORG_BRA"
ENTRUSTED_PAY = "OMI.KN_KLNB_DKSTZF_HS"
IMPORT_DOCS = "OMI.IS_BPD_HS"
FX_TRADE = "OMI.IS_TRN_HS"
PARTIES = "OMI.IS_GLE_HS"
DUE_PLAN = "OMI.KN_KLNB_DZQGJH_HS"
USER = "OMI.CL_USER_INFO_HS"
PERSON = "OMI.HR_BD_PSNDOC_HS"
CUST_ACCOUNT = "OMI.KN_KDPA_KEHUZH_HS"
TRANSFER = "OMI.KN_KLNB_ZCZRMX_HS"
ARREARS = "OMI.KN_KLNB_DKZHQG_HS"
ORG_PARAM = "OMI.KN_KBRP_JGCSHU_HS"
AGRI = "OMI.CL_ARGI_CONTRACT_HS"
SPECIAL = "OMI.CL_CUSTOMER_SPECIAL_HS"
PROVISION = "OMI.I9_ECL_FINAL_RESULT_HS"
INTEREST_LOG = "OMI.KN_KLNL_DKJXMX_HS"
INTERNAL_REGISTRIES = (("OMI.KN_KFAA_NBFHZH_HS", "zhanghao"), ("OMI.KN_KTAA_NBFHZH_HS", "zhanghao"),
                       ("OMI.KN_KTAB_CFTYDQ_HS", "zhanghao"), ("OMI.KN_KTAB_CFTYHQ_HS", "zhanghao"),
                       ("OMI.KN_KTAB_DXZDJB_HS", "daixzhxh"))
CHANGE_LOG = "OMI.KN_KLNL_DKBGMX_HS"
WASTEBOOK = "OMI.CL_BUSINESS_WASTEBOOK_HS"
INTERNAL_SUBJECT = "OMI.KN_KFAP_NEIBHS_HS"
SUBJECT = "OMI.KN_KFAP_KJKEMU_HS"
EXTENSION = "OMI.CL_BUSINESS_EXTENSION_HS"
CORP_CUSTOMER = "OMI.KN_KCFB_CFDGJC_HS"
CREDIT_CUSTOMER = "OMI.CL_CUSTOMER_XINDAIKEHU_HS"
CODE_MAP = "M_DICT_REMAPPING_DL"

# Codes and labels of the corporate credit system.
ENTRUSTED_SUBJECT = "企业委托贷款"
ENTRUSTED_TYPE = "2070"
BILL_FINANCING_PREFIX = "1020"
ADVANCE_PREFIX = "1130"
GUARANTY_ACTIVE = ("020", "040")
CURRENCY_CODENO = "Currency"
FORFAITING = "%福费廷%"
ACCT_TYP_DESC = ("银团贷款", "对公汽车按揭贷款")
NO_BASE_RATE_ICTYPES = ("020", "150")
ORG_REWRITE = {"0090102": "0090101"}
GREEN_TYPE_DICT, ACCT_TYP_DICT, BAIL_CURRENCY_DICT = "CL-GREENLOANPURPOSE-GREEN_LOAN_TYPE", "CL-TYPENAME-ACCT_TYP-2", "A0001"
MAP_BUSINESS_TYPE = "RSUM"
TRADE_SETTLEMENT = {"objtyp": "BPD", "inifrm": "BPTFFT"}
TRADE_RELATIONS = ("R", "F")
PARTY_SIDE, PARTY_ROLE = "C", "LO-CO1"
ENTRUSTED_DONE = "6"
CHANGE_FIELD = "huankzhh"
WASTEBOOK_SUBJECT = "0"
ADVANCE_ITEM_CD = "11420101"
SMALL_BALANCE, MID_BALANCE = 5000000, 10000000
SMALL_SCOPES = ("4", "5")
EXCLUDED_STRATEGIC = ("A0291", "A4099", "A9099")
STRATEGIC_BY_FIRST_DIGIT = {"7": "1", "1": "2", "4": "3", "2": "4", "6": "5", "3": "6", "5": "7", "8": "8", "9": "9"}
YANGTZE_ORG_PREFIXES = ("010", "012", "014")
DEPARTMENT_OVERRIDES = {"X2023033000011": "gjyw"}
ACCT_TYP_OVERRIDES = {"11850000cdjj002": "099903"}
INTL_TYPES4 = ("1070", "1080", "2050", "2020", "2022", "2030", "2040")
SUPPLY_CHAIN_TYPES4, SUPPLY_CHAIN_TYPES = ("1090", "2120"), ("1010070", "1010071", "1010072")
SYNDICATED_TYPES = ("1060", "1058010")
DRAWDOWN_TYPE_NEW = {"015": "展期", "060": "收回再贷", "080": "续授信", "085": "变更批复"}
INT_REPAY_FREQ = {"010": "03", "020": "04", "025": "05", "030": "06", "040": "07", "050": "99"}
MANUAL_INTEREST, MANUAL_INTEREST_DESC = "050", "手工计息"
INT_RATE_BY_ICTYPE = [(("020", "150"), "F"), (("90",), "L0"), (("30",), "L2"), (("40",), "L3"), (("50",), "L4"),
                      (("70", "80", "130", "140"), "L5")]
PURPOSE_BY_TYPE = [
    (("101001934", "1062", "1010010", "1010020", "101019032", "101019030", "101001932", "101001940", "101001942",
      "101001931", "101001930", "1010012", "1010112", "1010150", "1010100", "1010090", "1010120", "1010080",
      "1010160", "1010130", "1010110", "101001936", "101019034", "1010070", "1010140", "1010085", "101019036"), "2"),
    (("1030010", "1030020"), "3"),
    (("1010050", "1040010", "1050010", "1050020"), "1"),
    (("101019036", "1040030", "1058010", "1058020", "1060"), "4"),
]
GRADE = {"01": "1", "02": "2", "03": "3", "04": "4", "05": "5"}
LOAN_KIND = [(("010",), "1"), (("060",), "2"), (("020",), "3"), (("015", "030", "040", "050", "080", "085", "090"), "9"),
             (("095",), "91")]
REFINANCED_OCCURTYPES = ("020", "060", "090")
PRICING_BASE = {"005": "C", "010": "B02", "040": "A0201", "050": "A0202"}
REPAY_TYP_BY_ICCYC = [(("10", "60"), "1"), (("20", "70"), "2"), (("25", "80"), "3"), (("30", "90"), "4"), (("40",), "5")]
REPAY_TYP_BY_METHOD = [(("030",), "6"), (("040",), "5"), (("010", "020", "090"), "7")]
REPAY_TYP_DESC = {"010": "等额本金", "020": "等额本息", "090": "多次还息定制还本"}
PRINCIPAL_FREQ_BY_CYCLE = [("1Q%", "04"), ("1Y%", "06"), ("1M%", "03"), ("6M%", "05"), ("1H%", "05")]
INSTALMENT_METHODS = ("3", "4", "5", "6")
PRODUCT_TYPE_JS = {
    "1058010": "F12", "1058020": "F12", "1080050": "F081", "1080031": "F081", "T1310012": "F081", "1080090": "F081",
    "1080072": "F081", "1080071": "F081", "1080020": "F081", "1080070": "F081", "2050070": "F081", "1080220": "F081",
    "1070060": "F082", "1090040": "F082", "1090050": "F082", "1070040": "F082", "1090070": "F082", "1010071": "F082",
    "1080210": "F081", "1090060": "F082", "1010030": "F041", "1130010": "F052", "1130060": "F052", "1130050": "F059",
    "1130045": "F059", "1130080": "F059", "1130020": "F051", "1130030": "F053", "1130040": "F052", "1130070": "F059",
}
OTHER_ADVANCE_PRODUCT, FIXED_ASSET_PRODUCT, OPERATING_PRODUCT = "F059", "F023", "F022"
EXCLUDED_ORG_TYPE = "400410"
CONSTANTS = {
    "book_type": "2", "campus_consu_loan_flg": "N", "circle_loan_flg": "N", "consecute_term_num": 0,
    "internet_loan_flg": "N", "loan_buy_int": "N", "loan_purpose_country_new": "CHN", "low_risk_flag": "N",
    "orig_term_type": "D", "poverty_alle": "N", "tax_related_flg": "N", "transfers_loan_flg": "N",
    "undertak_guar_type": "N", "loan_purpose_country": "CHN", "int_adjest_amt": 0,
}


def _rename(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def _in(col: Column, rules: list[tuple[tuple[str, ...], str]], default: object = None) -> Column:
    return case_map([(col.isin(*codes), value) for codes, value in rules], default)


def guarantee_summary(cat: Catalog, run: RunDate) -> DataFrame:
    """Per contract: its own vouch type, the guarantee contracts' vouch type,
    the number of distinct guarantee kinds and the real-estate / other counts."""
    bc = cat.snapshot(CONTRACT, run).select("serialno", "vouchtype")
    cr = cat.snapshot(CONTRACT_REL, run).select("serialno", "objectno")
    gc = (cat.snapshot(GUARANTY, run).where(F.col("contractstatus").isin(*GUARANTY_ACTIVE))
          .select(F.col("serialno").alias("objectno"), F.col("vouchtype").alias("g_vouchtype"), "guarantytype"))
    j = bc.join(cr, "serialno", "left").join(gc, "objectno", "left")
    return j.groupBy(F.col("serialno").alias("gc_serialno")).agg(
        F.max("vouchtype").alias("gc_bcvouchtype"), F.max("g_vouchtype").alias("gc_vouchtype"),
        F.count_distinct(F.substring("guarantytype", 1, 3)).alias("gc_dblxs"),
        F.count(F.when(F.col("g_vouchtype").like("02010%"), F.col("objectno"))).alias("gc_fdcdys"),
        F.count(F.when(~F.col("g_vouchtype").like("005%"), F.col("objectno"))).alias("gc_qtdbs"))


def internal_accounts(cat: Catalog, run: RunDate) -> DataFrame:
    """Union of the internal-account registries (distinct account numbers),
    built once and used for both account roles."""
    parts = [cat.snapshot(t, run).select(F.col(c).alias("acct")) for t, c in INTERNAL_REGISTRIES]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.distinct()


def corporate_loans(cat: Catalog, run: RunDate) -> DataFrame:
    d = F.lit(run.d)
    bd = cat.snapshot(DUEBILL, run)
    ai = _rename(cat.snapshot(ADVANCED, run), "ai", ["duebillno", "oldduebillno"])
    duebills = cat.snapshot(DUEBILL, run)
    contracts = cat.snapshot(CONTRACT, run)
    bdold = _rename(duebills, "bdold", ["serialno", "relativeserialno2"])
    bcold = _rename(contracts, "bcold", ["serialno", "purpose"])
    adv = _rename(cat.snapshot(ACCEPT, run), "adv", ["warrant_no", "draft_number"])
    bc = _rename(contracts, "bc", [
        "serialno", "artificialno", "classifyresult", "ictype", "baserate", "occurtype", "manageuserid", "baseratetype",
        "greenloanpurpose", "ourrole", "direction", "businesstype", "businessprop", "vouchtype", "isftz", "bailcurrency",
        "bailratio", "purpose", "termmonth", "permanentassets"])
    ci = _rename(cat.snapshot(CUSTOMER, run), "ci", ["customerid", "mfcustomerid"])
    code = _rename(cat.snapshot(CODE_LIB, run).where(F.col("codeno") == CURRENCY_CODENO)
                   .select("itemno", "itemname", "bankno").distinct(), "code", ["itemno", "bankno"])
    bt = _rename(cat.snapshot(BUS_TYPE, run), "bt", ["typeno", "typename"])
    ents = cat.snapshot(ENTERPRISE, run)
    t7 = _rename(ents, "t7", ["customerid", "countrycode", "orgtype", "scope", "creditdate"])
    bp = _rename(cat.snapshot(PUTOUT, run), "bp", [
        "serialno", "baserate", "businessrate2", "paymenttype", "businesssum", "iccyc", "mostlyduebillno",
        "corpuspaymethod", "bailaccount", "insideaccountremark"])
    hk = _rename(cat.snapshot(REPAY_ATTR, run), "hk",
                 ["dkjiejuh", "benqqish", "zongqish", "huankzhh", "huankfsh", "dzhhkjih", "hkzhouqi"])
    kd = _rename(cat.snapshot(ACCOUNT_MAIN, run), "kd",
                 ["dkjiejuh", "dkzhhzht", "ysyjlixi", "ysyjfaxi", "kehuhaoo", "chanpdma", "dkzhangh"])
    ku = _rename(cat.snapshot(PRODUCT_CFG, run), "ku", ["yewusx01", "yewubima"])
    ky = _rename(cat.snapshot(PRODUCT_ATTR, run), "ky", ["yewubima", "yeshux09"])
    tt = _rename(cat.snapshot(RATE_ATTR, run), "tt", ["dkjiejuh", "xctxriqi", "xcyqtxrq", "xcnytxrq"])
    kf = _rename(cat.snapshot(DISB_ATTR, run), "kf", ["dkjiejuh", "dkrzhzhh"])
    internal = cat.snapshot(INTERNAL_ACCT, run)
    hb = _rename(internal, "hb", ["zhanghao", "zhyngyjg"])
    h = _rename(internal, "h", ["zhanghao", "zhanghmc"])
    kh4 = _rename(internal, "kh4", ["zhanghao", "zhyngyjg"])
    orgs_today = dated_dim(cat.read(ORG_BRANCH), run)
    ljg = _rename(orgs_today, "ljg", ["org_num", "org_nam"])
    jg2 = _rename(orgs_today, "jg2", ["org_num", "org_nam"])
    kkd = _rename(cat.snapshot(ENTRUSTED_PAY, run).where(F.col("stzfclzt") == ENTRUSTED_DONE), "kkd",
                  ["dkjiejuh", "dfzhangh", "dfzhkhhm"])
    bpd = _rename(cat.snapshot(IMPORT_DOCS, run), "bpd", ["jjh", "inr"])
    trn = cat.snapshot(FX_TRADE, run)
    for col, value in TRADE_SETTLEMENT.items():
        trn = trn.where(F.col(col) == value)
    trn = _rename(trn.where(F.col("relflg").isin(*TRADE_RELATIONS)), "trn", ["objinr", "inr"])
    gle2 = _rename(cat.snapshot(PARTIES, run).where((F.col("dbtcdt") == PARTY_SIDE) & (F.col("dbtdft") == PARTY_ROLE)),
                   "gle2", ["trninr", "act"])
    # next due date after D
    plan = cat.snapshot(DUE_PLAN, run).where(norm_date("daoqriqi") > d)
    kdz = plan.groupBy(F.col("dkjiejuh").alias("kdz_dkjiejuh")).agg(F.min(norm_date("daoqriqi")).alias("kdz_due"))
    ui = _rename(cat.snapshot(USER, run), "ui", ["userid", "certid"])
    bph = _rename(cat.snapshot(PERSON, run), "bph", ["id", "code"])
    accounts = cat.snapshot(CUST_ACCOUNT, run)
    kh = _rename(accounts, "kh", ["kehuzhao", "kehuzhmc", "kaihjigo"])
    kk = _rename(accounts, "kk", ["kehuzhao", "kehuzhmc", "kaihjigo"])
    kh2 = _rename(accounts, "kh2", ["kehuzhao", "kaihjigo"])
    kz = _rename(cat.snapshot(TRANSFER, run), "kz", ["dkjiejuh", "chulizht"])
    arrears = cat.snapshot(ARREARS, run).where(
        ((F.col("ysqianxi") + F.col("csqianxi") + F.col("yshofaxi") + F.col("cshofaxi")) > 0)
        & (F.col("benqizht") == "1"))
    ljqs = arrears.groupBy(F.col("dkjiejuh").alias("ljqs_dkjiejuh")).agg(F.count(F.lit(1)).alias("ljqs_leijqxqs"))
    org_param = cat.snapshot(ORG_PARAM, run)
    kj = _rename(org_param, "kj", ["jigouhao", "jigouzwm"])
    kj2 = _rename(org_param, "kj2", ["jigouhao", "jigouzwm"])
    kj3 = _rename(org_param, "kj3", ["jigouhao", "jigouzwm"])
    kj4 = _rename(org_param, "kj4", ["jigouhao", "diqdaima"])
    bd2 = duebills.where(
        ((F.col("businesstype").like("1%") & (F.col("businesstype") != "1020050"))
         | (F.col("businesstype").like("2%") & (F.col("businesstype") != ENTRUSTED_TYPE)))
        & (F.col("balance") > 0))
    ei2 = ents.where(F.coalesce(F.col("scope"), F.lit("5")).isin(*SMALL_SCOPES)).select("customerid")
    b2 = (bd2.join(ei2, "customerid").groupBy(F.col("customerid").alias("b2_customerid"))
          .agg(F.sum(F.coalesce(F.col("businesssum"), F.lit(0))).alias("b2_balancesum")))
    ag = _rename(cat.snapshot(AGRI, run), "ag", ["serialno"])
    csp = _rename(cat.snapshot(SPECIAL, run), "csp", ["serialno", "sectiontype"])
    i9 = _rename(cat.snapshot(PROVISION, run), "i9", ["asset_no", "ecl_final"])
    kx_log = date_window(cat.read(INTEREST_LOG), "jixiriqi", run.year_start, run.month_end)
    kx = kx_log.groupBy(F.col("dkjiejuh").alias("kx_dkjiejuh")).agg(
        F.sum(F.col("ysyjlixi") + F.col("ysyjfaxi") - F.col("ysyjxxsh")).alias("kx_s1"))
    registry = internal_accounts(cat, run)
    nbz = registry.select(F.col("acct").alias("nbz_zhanghao"))
    nbz1 = registry.select(F.col("acct").alias("nbz1_zhanghao"))
    # these logs are undated: the source compares their yyyyMMdd text, which reaches the scan
    changes = cat.read(CHANGE_LOG).where((F.col("jiaoyirq") <= run.d8) & (F.col("zhhujizd") == CHANGE_FIELD))
    hxbz = latest_by(changes, ["dkjiejuh", "xshjuzhi"], [F.col("xuhaoooo").desc_nulls_last()]).select(
        F.col("dkjiejuh").alias("hxbz_dkjiejuh"), F.col("xshjuzhi").alias("hxbz_xshjuzhi"),
        F.col("beizhuuu").alias("hxbz_beizhuuu"))
    wb = cat.read(WASTEBOOK).where(F.col("occurdate").between(f"{run.month_start:%Y%m%d}", run.d8)
                                   & (F.col("occursubject") == WASTEBOOK_SUBJECT))
    bw = latest_by(wb, ["relativeserialno"], [F.col("serialno").desc_nulls_last()]).select(
        F.col("relativeserialno").alias("bw_relativeserialno"), F.col("serialno").alias("bw_serialno"))
    nbhs = _rename(cat.snapshot(INTERNAL_SUBJECT, run), "nbhs", ["nbuhesdm", "kemuhaoo"])
    kjj = _rename(cat.snapshot(SUBJECT, run), "kjj", ["kemuhaoo", "kemumnch"])
    be = (cat.snapshot(EXTENSION, run).groupBy(F.col("relativeserialno").alias("be_relativeserialno"))
          .agg(F.min("lastmaturity").alias("be_maturity")))
    eii = _rename(ents, "eii", ["customerid", "industrytype"])
    customers = cat.snapshot(CUSTOMER, run)
    cii = latest_by(customers, ["customername"], [F.col("inputdate").desc_nulls_last()]).select(
        F.col("customerid").alias("cii_customerid"), F.col("mfcustomerid").alias("cii_mfcustomerid"))
    kc = _rename(cat.snapshot(CORP_CUSTOMER, run), "kc", ["kehuzhwm", "kehuhaoo", "hydmxlei", "hangyedm"])
    xdkh = latest_by(partition_only(cat.read(CREDIT_CUSTOMER), run), ["mfcustomerid"],
                     [F.col("begndt").desc_nulls_last()]).select(
        F.col("mfcustomerid").alias("xdkh_mfcustomerid"), F.col("industrytype").alias("xdkh_industrytype"))
    advanced_ids = cat.snapshot(ADVANCED, run).select(F.col("duebillno").alias("adv_id")).distinct()
    first_serial = duebills.agg(F.min("serialno")).scalar()
    maps = cat.read(CODE_MAP).where(F.col("business_type") == MAP_BUSINESS_TYPE)

    # The look-ups are attached level by level: all whose keys the level before
    # gave, together, on narrow rows. A join that depends on another look-up's match has
    # its key only where that one matched.
    def when_matched(column: str, key: Column) -> Column:
        return F.when(F.col(column).isNotNull(), key)

    serial, contract, customer = F.col("serialno"), F.col("relativeserialno2"), F.col("customerid")
    row_key = [serial]
    j = attach_many(bd, [
        Lookup(ai, ["ai_duebillno"], [serial]), Lookup(hk, ["hk_dkjiejuh"], [serial]), Lookup(kd, ["kd_dkjiejuh"], [serial]),
        Lookup(kf, ["kf_dkjiejuh"], [serial]), Lookup(bpd, ["bpd_jjh"], [serial]), Lookup(kz, ["kz_dkjiejuh"], [serial]),
        Lookup(ljqs, ["ljqs_dkjiejuh"], [serial], unique=True), Lookup(i9, ["i9_asset_no"], [serial]),
        Lookup(kx, ["kx_dkjiejuh"], [serial], unique=True), Lookup(bw, ["bw_relativeserialno"], [serial], unique=True),
        Lookup(be, ["be_relativeserialno"], [serial], unique=True), Lookup(advanced_ids, ["adv_id"], [serial], unique=True),
        Lookup(bc, ["bc_serialno"], [contract]), Lookup(ag, ["ag_serialno"], [contract]), Lookup(csp, ["csp_serialno"], [contract]),
        Lookup(bp, ["bp_serialno"], [F.col("relativeserialno1")]),
        Lookup(ci, ["ci_customerid"], [customer]), Lookup(t7, ["t7_customerid"], [customer]),
        Lookup(b2, ["b2_customerid"], [customer], unique=True), Lookup(eii, ["eii_customerid"], [customer]),
        Lookup(kj4, ["kj4_jigouhao"], [decode("mforgid", ORG_REWRITE, F.col("mforgid"))]),
        Lookup(code, ["code_itemno"], [F.col("businesscurrency")]), Lookup(bt, ["bt_typeno"], [F.col("businesstype")]),
    ], row_key, checks=cat.key_checks)
    scope = ((F.col("businesstype").like("1%") & ~F.col("businesstype").like(f"{BILL_FINANCING_PREFIX}%"))
             | (F.col("bc_businesstype") == ENTRUSTED_TYPE))
    old, entry, repay = F.col("ai_oldduebillno"), F.col("kf_dkrzhzhh"), F.col("hk_huankzhh")
    j = attach_many(j.where(scope), [
        Lookup(tt, ["tt_dkjiejuh"], [when_matched("kd_dkjiejuh", serial)]),
        Lookup(kdz, ["kdz_dkjiejuh"], [when_matched("kd_dkjiejuh", serial)], unique=True),
        Lookup(kkd, ["kkd_dkjiejuh"], [when_matched("kf_dkjiejuh", serial)]),
        Lookup(guarantee_summary(cat, run), ["gc_serialno"], [when_matched("bc_serialno", contract)], unique=True),
        Lookup(cii, ["cii_customerid"], [when_matched("eii_customerid", customer)]),
        Lookup(bdold, ["bdold_serialno"], [old]), Lookup(adv, ["adv_warrant_no"], [old]),
        Lookup(ku, ["ku_yewusx01"], ["kd_chanpdma"]), Lookup(hb, ["hb_zhanghao"], [entry]), Lookup(kh, ["kh_kehuzhao"], [entry]),
        Lookup(h, ["h_zhanghao"], [entry]), Lookup(trn, ["trn_objinr"], ["bpd_inr"]), Lookup(ui, ["ui_userid"], ["bc_manageuserid"]),
        Lookup(kh2, ["kh2_kehuzhao"], [repay]), Lookup(kh4, ["kh4_zhanghao"], [repay]),
        Lookup(code_values(maps, GREEN_TYPE_DICT, "m"), ["m_key"], ["bc_greenloanpurpose"]),
        Lookup(code_values(maps, ACCT_TYP_DICT, "m1"), ["m1_key"], ["bt_typeno"]),
        Lookup(code_values(maps, BAIL_CURRENCY_DICT, "m2"), ["m2_key"], ["bc_bailcurrency"]),
    ], row_key, materialize=True, checks=cat.key_checks)
    j = attach_many(j, [
        Lookup(bcold, ["bcold_serialno"], ["bdold_relativeserialno2"]), Lookup(ky, ["ky_yewubima"], ["ku_yewubima"]),
        Lookup(ljg, ["ljg_org_num"], ["hb_zhyngyjg"]), Lookup(kj, ["kj_jigouhao"], ["kh_kaihjigo"]),
        Lookup(gle2, ["gle2_trninr"], ["trn_inr"]), Lookup(bph, ["bph_id"], ["ui_certid"]),
        Lookup(kj2, ["kj2_jigouhao"], ["kh2_kaihjigo"]), Lookup(kj3, ["kj3_jigouhao"], ["kh4_zhyngyjg"]),
        Lookup(kc, ["kc_kehuzhwm"], ["cii_mfcustomerid"]),
    ], row_key, materialize=True, checks=cat.key_checks)
    j = j.withColumn("entry_acct", _entry_account()).withColumn(
        "repay_acct", F.coalesce(F.col("hk_huankzhh"), F.col("gle2_act")))
    j = attach_many(j, [
        Lookup(kk, ["kk_kehuzhao"], ["gle2_act"]), Lookup(xdkh, ["xdkh_mfcustomerid"], ["kc_kehuhaoo"], unique=True),
        Lookup(nbz, ["nbz_zhanghao"], ["entry_acct"], unique=True), Lookup(nbz1, ["nbz1_zhanghao"], ["repay_acct"], unique=True),
        Lookup(hxbz, ["hxbz_dkjiejuh", "hxbz_xshjuzhi"], [serial, F.col("repay_acct")], unique=True),
        Lookup(nbhs, ["nbhs_nbuhesdm"], [F.expr("substring(ky_yeshux09, 4)")]),
    ], row_key, materialize=True, checks=cat.key_checks)
    j = (j.join(jg2, F.col("kk_kaihjigo") == jg2.jg2_org_num, "left")
         .join(kjj, kjj.kjj_kemuhaoo == F.coalesce(F.col("nbhs_kemuhaoo"), F.col("ky_yeshux09")), "left"))
    # the source looks the code up only for roles outside the excluded set
    strategic = (cat.snapshot(CODE_LIB, run).where(~F.col("itemno").isin(*EXCLUDED_STRATEGIC))
                 .select(F.col("itemno").alias("bc_ourrole"), "itemdescribe"))
    j = lookup_unique(j, strategic, ["bc_ourrole"], ["itemdescribe"], name="strategic industry code")
    return j.select(*[expr.alias(name) for name, expr in _columns(run, first_serial).items()])


def _entry_account() -> Column:
    """Entry account: the disbursement account, or the entrusted payee when
    one exists, with the trade-settlement party account first for
    forfaiting business."""
    disb = (F.when(F.col("hb_zhanghao").isNull(), F.col("kf_dkrzhzhh"))
            .when(F.col("kkd_dfzhangh").isNotNull(), F.col("kkd_dfzhangh")).otherwise(F.col("kf_dkrzhzhh")))
    return F.when(F.col("bt_typename").like(FORFAITING), F.coalesce(F.col("gle2_act"), disb)).otherwise(
        F.coalesce(disb, F.col("gle2_act")))


def _guaranty_typ() -> Column:
    v, bv = F.col("gc_vouchtype"), F.col("gc_bcvouchtype")
    fd, qt, n = F.col("gc_fdcdys"), F.col("gc_qtdbs"), F.col("gc_dblxs")
    one = (F.when(v.like("040%"), "A").when(v.like("010%") | (v == "050"), "C99")
           .when((fd > 0) & bv.like("02010%"), "B01").when((fd > 0) & (qt > 0), "E01").when(v.like("020%"), "B99"))
    many = F.when((fd > 0) & bv.like("02010%"), "B01").when((fd > 0) & (qt > 0), "E01").otherwise("E")
    return F.trim(F.when(n == 1, one).when(n == 0, "D").when(n > 1, many))


def _columns(run: RunDate, first_serial: Column) -> dict[str, Column]:
    d = F.lit(run.d)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    btype, bc_type = F.col("businesstype"), F.col("bc_businesstype")
    principal_owed = F.coalesce(F.round(z("overduebalance") + z("dullbalance") + z("badbalance"), 2), F.lit(0))
    interest_owed_raw = (F.col("interestbalance1") + F.col("interestbalance2") + F.col("finebalance1")
                         + F.col("finebalance2"))
    interest_owed = z("interestbalance1") + z("interestbalance2") + z("finebalance1") + z("finebalance2")
    entrusted = F.col("finishdate").isNull() & (F.col("kjj_kemumnch") == ENTRUSTED_SUBJECT)
    cls = F.col("bc_classifyresult")
    acct_sts = (F.when(entrusted & cls.isin("01"), "1")
                .when(entrusted & cls.isin("02", "03", "04", "05"), "2")
                .when(((principal_owed + interest_owed_raw) > 0) & (btype != ENTRUSTED_TYPE), "2")
                .when(F.col("finishdate").isNotNull(), "3").otherwise("1"))
    ictype = F.col("bc_ictype")
    no_base_rate = ictype.isin(*NO_BASE_RATE_ICTYPES)
    bankno = F.col("code_bankno")
    type4 = F.substring(btype, 1, 4)
    department = F.trim(case_map(
        [(F.col("serialno") == k, v) for k, v in DEPARTMENT_OVERRIDES.items()]
        + [(type4.isin(*INTL_TYPES4), "gjyw"), (btype == "2090030", "gjyw"),
           (type4.isin(*SUPPLY_CHAIN_TYPES4), "gyl"), (btype.isin(*SUPPLY_CHAIN_TYPES), "gyl"),
           (btype.isin(*SYNDICATED_TYPES) & (bankno == "CNY"), "ytdk"),
           (btype.isin(*SYNDICATED_TYPES) & (bankno != "CNY"), "gjyw")], "dgdk"))
    acct_typ = case_map([(F.col("serialno") == k, v) for k, v in ACCT_TYP_OVERRIDES.items()],
                        F.coalesce(F.col("m1_new_values"), F.lit("099901")))
    ourrole = F.col("bc_ourrole")
    strategic = case_map([(F.col("itemdescribe").like(f"{digit}%"), v) for digit, v in STRATEGIC_BY_FIRST_DIGIT.items()])
    direction4 = F.substring("bc_direction", 2, 4)
    int_date = F.when(interest_owed > 0, norm_date(F.coalesce(F.col("intdate"), F.col("actualmaturity"))))
    vouch = F.col("bc_vouchtype")
    vouch3 = F.substring(vouch, 1, 3)
    occ = F.col("bc_occurtype")
    huankfsh, cycle = F.col("hk_huankfsh"), F.col("hk_hkzhouqi")
    instalment = huankfsh.isin(*INSTALMENT_METHODS)
    ppl_freq = case_map([(huankfsh == "1", "07"), ((huankfsh == "2") & (F.col("hk_dzhhkjih") == "0"), "07"),
                         ((huankfsh == "2") & (F.col("hk_dzhhkjih") == "1"), "99")]
                        + [(instalment & cycle.like(p), v) for p, v in PRINCIPAL_FREQ_BY_CYCLE], "99")
    remark = F.when(F.col("nbz_zhanghao").isNotNull() | F.col("nbz1_zhanghao").isNotNull(),
                    concat_null_as_empty("bp_insideaccountremark", text_after("hxbz_beizhuuu", "]"))).otherwise("")
    loan_term = term_months(norm_date("putoutdate"), norm_date("maturity"))
    gv = F.col("bc_vouchtype")
    guaranty_js = F.when(btype.like("1%") & ~btype.like(f"{ADVANCE_PREFIX}%") & ~btype.like(f"{BILL_FINANCING_PREFIX}%")
                         & (F.coalesce(F.col("t7_orgtype"), F.lit("1")) != EXCLUDED_ORG_TYPE),
                         F.when(gv.like("010%"), "C99")
                         .when(gv.like("020%"), F.when(gv.like("02010%"), "B01").otherwise("B99"))
                         .when(gv.like("040%") | gv.like("050%"), "A").when(gv.like("005%"), "D").otherwise("Z"))
    product_js = F.trim(decode(btype, PRODUCT_TYPE_JS).otherwise(
        F.when(type4 == ADVANCE_PREFIX, OTHER_ADVANCE_PRODUCT)
        .when(F.col("bc_permanentassets") == "1", FIXED_ASSET_PRODUCT).otherwise(OPERATING_PRODUCT)))
    cols: dict[str, Column] = {
        "acct_num": F.coalesce("bc_artificialno", "relativeserialno2"),
        "acct_sts": acct_sts,
        "acct_sts_fhz": decode("kd_dkzhhzht", {"0": "1", "1": "3"}, "1"),
        "acct_sts_xmdk": F.when((F.col("overduebalance") + F.col("dullbalance") + F.col("badbalance")) > 0, "2")
                          .when(F.col("finishdate").isNotNull(), "3").otherwise("1"),
        "acct_typ": acct_typ,
        "acct_typ_desc": F.when(F.col("bt_typename").isin(*ACCT_TYP_DESC), F.col("bt_typename")),
        "accu_int_amt": F.col("kd_ysyjlixi") + F.col("kd_ysyjfaxi"),
        "accu_int_flg": F.when(ictype == "010", "N").otherwise("Y"),
        "actual_maturity_dt": norm_date("actualmaturity"),
        "base_int_rat": F.when(no_base_rate, F.lit(None).cast("string"))
                         .otherwise(rate_text(F.round(F.col("bc_baserate"), 5))),
        "cancel_flg": F.when(F.col("kd_dkzhhzht") == "2", "Y").otherwise("N"),
        "cumulate_term_num": F.when((principal_owed + interest_owed) > 0,
                                    F.greatest(z("ljqs_leijqxqs"), F.lit(1).cast("bigint"))).otherwise(F.lit(0)),
        "current_term_num": F.coalesce(F.col("hk_benqqish"), F.lit(1)),
        "curr_cd": bankno,
        "cust_id": F.coalesce("mfcustomerid", "ci_mfcustomerid", "kd_kehuhaoo"),
        "departmentd": department,
        "drawdown_amt": F.col("businesssum"),
        "drawdown_base_int_rat": F.when(no_base_rate, F.lit(None)).otherwise(F.col("bp_baserate")),
        "drawdown_dt": norm_date("putoutdate"),
        "drawdown_real_int_rat": F.col("bp_businessrate2"),
        "drawdown_type": F.when(F.col("bp_paymenttype") == "1", "B").otherwise("A"),
        "drawdown_type_new": decode(occ, DRAWDOWN_TYPE_NEW),
        "emp_id": F.coalesce(F.replace(F.upper("bph_code"), F.lit("C"), F.lit("")), F.col("bc_manageuserid")),
        "entrust_pay_amt": F.when(F.col("bp_paymenttype") == "1", F.col("bp_businesssum")),
        "extendterm_flg": F.when(F.col("extendtimes") != 0, "Y").otherwise("N"),
        "finish_dt": norm_date("finishdate"),
        "float_type": decode("bc_baseratetype", {"5": "A", "010": "B"}, "C"),
        "fund_use_loc_cd": F.when(F.col("t7_countrycode") != "CHN", "O").otherwise("I"),
        "generalize_loan_flg": F.when(
            (F.col("t7_orgtype").isNull() & (F.col("b2_balancesum") <= SMALL_BALANCE))
            | (F.coalesce(F.col("t7_scope"), F.lit("5")).isin(*SMALL_SCOPES) & F.col("ag_serialno").isNotNull()
               & (F.col("b2_balancesum") <= MID_BALANCE)), "Y").otherwise("N"),
        "sp_prov_amt": F.col("i9_ecl_final"),
        "gov_bondmorg_flg": F.when(F.col("csp_sectiontype") == "95", "Y").otherwise("N"),
        "green_loan_flg": F.when(F.coalesce(F.col("bc_greenloanpurpose"), F.lit("0")) != "0", "Y").otherwise("N"),
        "green_loan_type": F.col("m_new_values"),
        "guaranty_typ": _guaranty_typ(),
        "independence_pay_amt": F.when(F.col("bp_paymenttype") != "1", F.col("bp_businesssum")),
        "indust_stg_type": F.when(ourrole.isNotNull() & ~ourrole.isin(*EXCLUDED_STRATEGIC), strategic),
        "indust_tran_flg": F.when(direction4.isin(*UPGRADE_INDUSTRIES), "1").otherwise("2"),
        "int_rate_typ": F.trim(F.when(btype.like(f"{ADVANCE_PREFIX}%"), "F").otherwise(_in(ictype, INT_RATE_BY_ICTYPE, "L9"))),
        "int_repay_freq": decode("bp_iccyc", INT_REPAY_FREQ, "03"),
        "int_repay_freq_desc": F.when(F.col("bp_iccyc") == MANUAL_INTEREST, MANUAL_INTEREST_DESC),
        "is_first_report_loan_tag": F.when((F.col("putoutdate") == F.col("t7_creditdate"))
                                           & (F.col("serialno") == first_serial), "Y").otherwise("N"),
        "is_repay_options": F.when(no_base_rate, "Y").otherwise("N"),
        "item_cd": F.when(F.col("trn_inr").isNotNull(), ADVANCE_ITEM_CD).otherwise(
            F.coalesce(F.col("nbhs_kemuhaoo"), F.col("ky_yeshux09"))),
        "i_od_dt": int_date,
        "loans_to_culture_flag": F.when(direction4.isin(*CULTURE_INDUSTRIES), "Y").otherwise("N"),
        "loan_acct_bal": F.col("balance"),
        "loan_acct_bank": F.coalesce("kj_jigouzwm", "kkd_dfzhkhhm", "jg2_org_nam", "ljg_org_nam"),
        "loan_acct_name": F.coalesce("kh_kehuzhmc", "h_zhanghmc", "kk_kehuzhmc"),
        "loan_acct_num": F.col("entry_acct"),
        "loan_business_typ": F.when(F.col("adv_id").isNotNull(), "9").otherwise(_in(bc_type, PURPOSE_BY_TYPE, "4")),
        "loan_fhz_num": F.coalesce("kd_dkzhangh", "serialno"),
        "loan_grade_cd": F.trim(F.when(cls.isNull(), "1").otherwise(decode(cls, GRADE))),
        "loan_kind_cd": _in(occ, LOAN_KIND, "1"),
        "loan_num": F.col("serialno"),
        "loan_num_old": F.when(occ.isin(*REFINANCED_OCCURTYPES), F.col("bp_mostlyduebillno")).otherwise(""),
        "loan_purpose_area": F.col("kj4_diqdaima"),
        "loan_purpose_cd": F.coalesce(F.replace(F.col("bc_direction"), F.lit("*"), F.lit("")),
                                      F.col("xdkh_industrytype"), F.col("eii_industrytype"), F.col("kc_hydmxlei"),
                                      F.col("kc_hangyedm")),
        "loan_ratio": F.col("bc_businessprop"),
        "loan_sell_int": F.when(F.col("kz_chulizht") == "1", "Y").otherwise("N"),
        "main_guaranty_typ": (F.when(vouch3.isin("040", "050"), "0").when(vouch.like("020%"), "1")
                              .when(vouch3.isin("010", "070"), "2").when(vouch == "005", "3")),
        "maturity_dt": F.when(btype.like(f"{ADVANCE_PREFIX}%"), F.lit(None).cast("date"))
                        .when(F.col("extendtimes") > 0, norm_date("be_maturity"))
                        .otherwise(norm_date("actualmaturity")),
        "year_int_incom": F.col("kx_s1"),
        "next_int_pay_dt": F.col("kdz_due"),
        "next_repricing_dt": (
            F.when(F.col("tt_xctxriqi").isNotNull(), norm_date("tt_xctxriqi"))
            .when(F.col("tt_xcyqtxrq").isNotNull(), norm_date("tt_xcyqtxrq"))
            .when(F.col("tt_xcnytxrq").isNotNull(), norm_date("tt_xcnytxrq"))
            .otherwise(F.when(F.col("extendtimes") > 0, norm_date("maturity")).otherwise(norm_date("actualmaturity")))),
        "od_days": F.greatest(F.coalesce(F.datediff(d, norm_date("overduedate")) + 1, F.lit(0)),
                              F.coalesce(F.datediff(d, int_date) + 1, F.lit(0))),
        "od_flg": F.when((z("overduebalance") + z("interestbalance1") + z("finebalance1") + z("interestbalance2")
                          + z("finebalance2")) > 0, "Y").otherwise("N"),
        "od_int": z("interestbalance1") + z("finebalance1"),
        "od_int_obs": z("interestbalance2") + z("finebalance2"),
        "od_loan_acct_bal": principal_owed,
        "org_num": decode("mforgid", ORG_REWRITE, F.col("mforgid")),
        "orig_acct_no": F.coalesce("adv_draft_number", "bdold_relativeserialno2"),
        "orig_term": F.datediff(norm_date("maturity"), norm_date("putoutdate")),
        "oversea_ann_loan_flag": F.when((F.col("m1_new_values") == "0203") & (F.col("t7_countrycode") != "CHN"), "Y")
                                  .otherwise("N"),
        "pay_acct_bank": F.coalesce("kj2_jigouzwm", "kj3_jigouzwm", "jg2_org_nam"),
        "pay_acct_num": F.col("repay_acct"),
        "pftz_loan_flg": F.col("bc_isftz"),
        "pricing_base_type": F.trim(decode("bc_baseratetype", PRICING_BASE, "Z99")),
        "p_od_dt": norm_date("overduedate"),
        "real_int_rat": F.col("businessrate2"),
        "renew_flg": F.when(occ == "090", "Y").otherwise("N"),
        "repay_flg": F.when(occ == "020", "Y").otherwise("N"),
        "repay_term_num": F.coalesce(F.col("hk_zongqish"), F.lit(1)),
        "repay_typ": _in(F.col("iccyc"), REPAY_TYP_BY_ICCYC).otherwise(
            _in(F.col("bp_corpuspaymethod"), REPAY_TYP_BY_METHOD, "6")),
        "repay_typ_desc": decode("bp_corpuspaymethod", REPAY_TYP_DESC),
        "security_acct_num": F.col("bp_bailaccount"),
        "security_amt": F.col("bailsum"),
        "security_curr": F.col("m2_new_values"),
        "security_rate": F.coalesce(F.col("bc_bailratio"), F.lit("0")),
        "useofunds": F.when(btype.like(f"{ADVANCE_PREFIX}%"), F.col("bcold_purpose")).otherwise(F.col("bc_purpose")),
        "yangtze_river_loan_flg": F.when(F.substring("kj_jigouhao", 1, 3).isin(*YANGTZE_ORG_PREFIXES), "Y")
                                   .otherwise("N"),
        "ppl_repay_freq": ppl_freq,
        "remark": remark,
        "orig_term_bc": F.when(F.col("extendtimes") != 0, F.coalesce(F.col("bc_termmonth"), loan_term)).otherwise(loan_term),
        "drawdown_num": F.col("bw_serialno"),
        "guaranty_typ_js": guaranty_js,
        "cust_id_js": F.coalesce("ci_mfcustomerid", "ci_customerid", "kd_kehuhaoo"),
        "product_type_js": product_js,
        "lcstatus": F.col("lcstatus"),
        "acct_num_cqcs": F.col("bc_serialno"),
    }
    for name, value in CONSTANTS.items():
        cols[name] = F.lit(value)
    return cols
