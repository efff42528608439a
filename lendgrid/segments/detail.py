"""Loan detail (the intermediate 50-column table of personal loans).

One row per active personal loan that is not charged off, with its month-end
balance (or zeros for loans settled since the start of the year), customer
and address, repayment style, purpose group, customer credit totals and the
overdue report of the day. The ledger's personal-loan segment reads it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendgrid.functions import concat_null_as_empty, decode, norm_date, substr1
from lendgrid.operators import lookup_unique, top1_by_max
from lendgrid.rundate import RunDate
from lendgrid.segments.catalog import Catalog

# Source table names.
LOAN = "OMI.PL_LOAN_HS"
TERM = "OMI.PL_LOAN_SCHD_TERM_HS"
LOAN_PARA = "OMI.PL_LOAN_PARA_HS"
PMSH_HDR = "OMI.PL_PMSH_HDR_HS"
MONTH_BAL = "OMI.PL_LOAN_MONTH_BAL_HS"
PURPOSE = "OMI.PL_PRPS_FIN_HS"
PROVINCE = "OMI.PL_PROVINCE_CDE_HS"
CITY = "OMI.PL_CITY_HS"
DISTRICT = "OMI.PL_DISTRICT_HS"
COLT_IDX = "OMI.PL_COLT_IDX_HS"
COLT_COM = "OMI.PL_COLT_COM_HS"
CLR_INFO = "OMI.COL_CLR_INFO_HS"
CLR_REALTY = "OMI.COL_CLR_ASSET_REALTY_HS"
INDIV = "OMI.PL_INDIV_INFO_HS"
CUST = "OMI.PL_CUST_INFO_HS"
OD_REPORT = "OMI.PL_RPT_LN_OS_DTL_HS"

# Codes and labels of the personal-loan system.
CHARGED_OFF = "CHRGO"
EXCLUDED_STATUSES = ("NBAP", "REVS")
SETTLED, ACTIVE = "SETL", "ACTV"
INTEREST_ONLY = "IO"
DEFAULT_PURPOSE = "18"
BUSINESS, CONSUMER = "经营", "消费"
REALTY_LOAN_TYPE = "10"
BUSINESS_TYPES, CONSUMER_TYPES, PURPOSE_TYPES = ("14", "16"), ("10", "11", "13"), ("12", "18")
REALTY_TYPE, REALTY_CLASS, REALTY_SOURCE = "SP", "03010204", "02"
COLLATERAL_KINDS = ("PTY", "LND")
BRANCH_PREFIX = "010"
HOME = "H"
LOAN_KEY = ["lnpa_istu_insttu_cde", "lnpa_loan_typ", "loan_no"]
CUST_KEY = ["ctif_id_type", "ctif_id_no", "ctif_iss_ctry"]
STYLE = {
    "flexible": "随心还还款法", "combined": "组合还款", "balloon": "气球贷", "step_up": "等额递增还款",
    "step_down": "等额递减还款", "interest_only": "净息还款", "annuity": "等额本息", "fixed_installment": "固定期供金额",
    "freq_mismatch": "本息间隔不一致", "equal_principal": "等额本金", "interest_then_principal": "按期还息到期还本",
    "bullet": "利随本清",
}
MINBUSS_SOLE, MINBUSS_SMALL, MINBUSS_NONE = "个体工商户", "小微企业主", "否"
LOAN_IND = {"E": "续贷", "R": "借新还旧"}
LOAN_IND_NORMAL, LOAN_IND_OTHER = "正常", "其它"
DETAIL_COLUMNS = (
    "rpt_dt loan_no loan_typ home_addr loan_tnr prps_fin loan_grp loan_grp2 addr_typ loan_target pay_typ buss_typ "
    "minbuss idsy_pfsn empr emp_contact_add place_orign acct_offcr loan_grd os_days bch_cde id_no id_type iss_ctry "
    "cust_nam actv_dt last_due_dt orig_prcp os_prcp base_rate int_adj_pct sprd main_gur_typ recv_int susp_int "
    "od_prcp_day od_prcp_amt od_int_day od_int_amt od_od_int_day od_od_int_amt sts first_hos inc_hos sum_orig_prcp "
    "sum_orig_opr sum_orig_con is_loan_green loan_target_green loan_ind"
).split()


def _not_charged_off(df: DataFrame) -> DataFrame:
    return df.where(F.col("debt_sts") != CHARGED_OFF)


def last_terms(cat: Catalog, run: RunDate, loans: DataFrame) -> DataFrame:
    """Schedule terms at each loan's last term number (ties kept)."""
    terms = cat.snapshot(TERM, run).withColumn("loan_no", F.col("loan_no").cast("string")).select(
        *LOAN_KEY, "term_no", "pgs_prcp_amt", "repaym_typ", "repaym_opt")
    return top1_by_max(terms, LOAN_KEY, "term_no").join(loans.select(*LOAN_KEY), LOAN_KEY).drop("term_no")


def interest_only_terms(cat: Catalog, run: RunDate, loans: DataFrame) -> DataFrame:
    terms = (cat.snapshot(TERM, run).where(F.col("repaym_opt") == INTEREST_ONLY)
             .withColumn("loan_no", F.col("loan_no").cast("string")).select(*LOAN_KEY))
    return terms.join(loans.select(*LOAN_KEY), LOAN_KEY).groupBy(*LOAN_KEY).agg(F.count(F.lit(1)).alias("ip"))


def repayment_style(cat: Catalog, run: RunDate, loans: DataFrame) -> DataFrame:
    """Repayment style per loan (12 outcomes)."""
    lp = cat.snapshot(LOAN_PARA, run).select(F.col("loan_typ").alias("lnpa_loan_typ"), "irreg_ind", "instm_ln_ind")
    ph = cat.snapshot(PMSH_HDR, run).select(
        F.col("loan_lnpa_istu_insttu_cde").alias("lnpa_istu_insttu_cde"),
        F.col("loan_lnpa_loan_typ").alias("lnpa_loan_typ"), F.col("loan_loan_no").cast("string").alias("loan_no"),
        "prcp_paym_freq", "int_paym_freq")
    base = loans.where(~F.col("sts").isin(*EXCLUDED_STATUSES)).select(*LOAN_KEY, "term_combine_ind", "balloon_ind")
    j = (base.join(lp, "lnpa_loan_typ").join(last_terms(cat, run, loans), LOAN_KEY)
         .join(interest_only_terms(cat, run, loans), LOAN_KEY, "left").join(ph, LOAN_KEY))
    yes = lambda c: F.coalesce(F.col(c), F.lit("N")) == "Y"
    ip = F.coalesce(F.col("ip"), F.lit(0))
    pgs = F.coalesce(F.col("pgs_prcp_amt"), F.lit(0))
    rt = F.col("repaym_typ")
    freq_differs = F.coalesce(F.col("prcp_paym_freq"), F.lit(0)) != F.coalesce(F.col("int_paym_freq"), F.lit(1))
    by_type = (F.when(rt == "T", STYLE["annuity"]).when(rt == "A", STYLE["fixed_installment"])
               .when(rt == "P", F.when(freq_differs, STYLE["freq_mismatch"]).otherwise(STYLE["equal_principal"])))
    instalment = (F.when(yes("term_combine_ind"), STYLE["combined"])
                  .when(yes("balloon_ind"), STYLE["balloon"])
                  .when(pgs > 0, STYLE["step_up"]).when(pgs < 0, STYLE["step_down"])
                  .when(ip == 1, STYLE["interest_only"])
                  .when(ip == 0, by_type))
    style = (F.when(yes("irreg_ind"), STYLE["flexible"])
             .when(yes("instm_ln_ind"), instalment)
             .otherwise(F.when(ip > 0, STYLE["interest_then_principal"]).otherwise(STYLE["bullet"])))
    return j.select(*LOAN_KEY, style.alias("pay_typ"))


def month_balances(cat: Catalog, run: RunDate) -> DataFrame:
    """Month-end balances of the day, plus loans settled since the start of
    the year with zero balances (a distinct union)."""
    lb = cat.snapshot(MONTH_BAL, run).where(norm_date("bal_date") == F.lit(run.d)).select(
        F.col("insttu_cde").alias("lnpa_istu_insttu_cde"), F.col("loan_typ").alias("lnpa_loan_typ"),
        F.col("loan_no").cast("string").alias("loan_no"), "loan_grd",
        F.col("os_days").cast("int").alias("os_days"), F.col("os_prcp").cast("decimal(20,2)").alias("os_prcp"),
        F.col("recv_int").cast("decimal(20,2)").alias("recv_int"), F.col("susp_int").cast("decimal(20,2)").alias("susp_int"))
    actv = norm_date("actv_dt")
    zero = F.lit(0).cast("decimal(20,2)")
    settled = cat.snapshot(LOAN, run).where(
        (actv >= F.lit(run.year_start)) & (actv <= F.lit(run.d)) & (F.col("sts") == SETTLED)).select(
        "lnpa_istu_insttu_cde", "lnpa_loan_typ", F.col("loan_no").cast("string").alias("loan_no"), "loan_grd",
        F.lit(0).alias("os_days"), zero.alias("os_prcp"), zero.alias("recv_int"), zero.alias("susp_int"))
    out = lb.unionByName(settled).distinct()
    return out.select(*LOAN_KEY, *[F.col(c).alias(f"lb_{c}") for c in ("loan_grd", "os_days", "os_prcp", "recv_int",
                                                                         "susp_int")])


def _purpose_flag(cat: Catalog, run: RunDate, df: DataFrame) -> DataFrame:
    """Adds ``pf_found`` / ``pf_is_operate`` for the loan's purpose code
    (NULL purpose means the default code); a key-checked scalar lookup, made only
    for the loan types that the source looks up."""
    pf = cat.snapshot(PURPOSE, run).select(F.col("prps_cde").alias("pf_key"), F.col("is_operate").alias("pf_is_operate"),
                                           F.lit(True).alias("pf_found"))
    looked_up = substr1("lnpa_loan_typ", 2).isin(*PURPOSE_TYPES)
    keyed = df.withColumn("pf_key", F.when(looked_up, F.coalesce(F.col("prps_fin"), F.lit(DEFAULT_PURPOSE))))
    return lookup_unique(keyed, pf, ["pf_key"], ["pf_is_operate", "pf_found"], name="loan purpose").drop("pf_key")


def customer_totals(cat: Catalog, run: RunDate) -> DataFrame:
    """Original principal per customer: all, business and consumer."""
    lp = cat.snapshot(LOAN_PARA, run).where(
        (F.coalesce(F.col("pf_ind"), F.lit("N")) == "N") & (F.coalesce(F.col("trust_ln_ind"), F.lit("N")) == "N")
    ).select(F.col("loan_typ").alias("lnpa_loan_typ"))
    loans = cat.snapshot(LOAN, run).where(
        (F.col("sts") == ACTIVE) & (F.col("orig_prcp") > 0) & (F.col("os_prcp") > 0)).join(lp, "lnpa_loan_typ")
    loans = _purpose_flag(cat, run, loans)
    typ2 = substr1("lnpa_loan_typ", 2)
    found = F.col("pf_found").isNotNull()
    opr = typ2.isin(*BUSINESS_TYPES) | (typ2.isin(*PURPOSE_TYPES) & (F.col("pf_is_operate") == "Y"))
    con = typ2.isin(*CONSUMER_TYPES) | (typ2.isin(*PURPOSE_TYPES) & found
                                        & (F.coalesce(F.col("pf_is_operate"), F.lit("N")) != "Y"))
    amt = F.col("orig_prcp")
    return loans.groupBy(*CUST_KEY).agg(
        F.sum(amt).alias("sum_orig_prcp"),
        F.sum(F.when(opr, amt).otherwise(F.lit(0))).alias("sum_orig_opr"),
        F.sum(F.when(con, amt).otherwise(F.lit(0))).alias("sum_orig_con"))


def realty_flags(cat: Catalog, run: RunDate) -> DataFrame:
    """Per loan number: 'Y' when its collateral is a specific-type realty."""
    ci = cat.snapshot(COLT_IDX, run).select(F.col("loan_loan_no").cast("string").alias("loan_loan_no"), "clcm_colt_itm")
    com = cat.snapshot(COLT_COM, run).where(F.col("clty_colt_typ").isin(*COLLATERAL_KINDS)).select(
        F.col("colt_itm").alias("clcm_colt_itm"))
    a2 = cat.snapshot(CLR_INFO, run).where(F.col("sourcesystem") == REALTY_SOURCE).select(
        F.col("clrid").alias("clcm_colt_itm"), "clrtypeid")
    p = cat.snapshot(CLR_REALTY, run).select(F.col("clrid").alias("clcm_colt_itm"), "lsrealtytype")
    chain = ci.join(com, "clcm_colt_itm").join(a2, "clcm_colt_itm").join(p, "clcm_colt_itm")
    flag = F.when((F.col("lsrealtytype") == REALTY_TYPE) & (F.col("clrtypeid") == REALTY_CLASS), "Y").otherwise("N")
    return chain.select(F.col("loan_loan_no").alias("loan_no"), flag.alias("realty_flag"))


def _home_address(cat: Catalog, run: RunDate, c: DataFrame) -> DataFrame:
    """The first address slot typed home, with province, city and district
    codes of slots 1-3 resolved to names. The slot is chosen first, so three
    lookups serve all five slots."""
    slot = None
    for n in range(1, 6):
        cond = F.col(f"addr{n}_type") == HOME
        slot = F.when(cond, F.lit(n)) if slot is None else slot.when(cond, F.lit(n))
    c = c.withColumn("home_slot", slot)

    def pick(field: str, slots=range(1, 6)) -> Column:
        expr = None
        for n in slots:
            cond = F.col("home_slot") == n
            v = F.col(f"addr{n}_{field}")
            expr = F.when(cond, v) if expr is None else expr.when(cond, v)
        return expr

    c = c.select("*", pick("province_cde", range(1, 4)).alias("h_prov"), pick("lct_cde", range(1, 4)).alias("h_city"),
                 pick("dist_cde", range(1, 4)).alias("h_dist"),
                 *[pick(f"l{i}").alias(f"h_l{i}") for i in range(1, 5)])
    prov = cat.snapshot(PROVINCE, run).select(F.col("province_cde").alias("h_prov"), "province_desc")
    city = cat.snapshot(CITY, run).select(F.col("city_cde").alias("h_city"), "city_desc")
    dist = cat.snapshot(DISTRICT, run).select(F.col("dist_cde").alias("h_dist"), "dist_nam")
    c = lookup_unique(c, prov, ["h_prov"], ["province_desc"], name="province")
    c = lookup_unique(c, city, ["h_city"], ["city_desc"], name="city")
    c = lookup_unique(c, dist, ["h_dist"], ["dist_nam"], name="district")
    addr = concat_null_as_empty("province_desc", "city_desc", "dist_nam", "h_l1", "h_l2", "h_l3", "h_l4")
    return c.withColumn("home_addr", F.when(F.col("home_slot").isNotNull(), addr))


def loan_detail(cat: Catalog, run: RunDate) -> DataFrame:
    loans = _not_charged_off(cat.snapshot(LOAN, run)).withColumn("loan_no", F.col("loan_no").cast("string"))
    lb = month_balances(cat, run)
    ii = cat.snapshot(INDIV, run).select(*CUST_KEY, "fin_insttu", "fin_insttu_2", "empr", "emp_contact_add",
                                         "place_orign")
    c = cat.snapshot(CUST, run)
    c = _home_address(cat, run, c).select(
        F.col("id_type").alias("ctif_id_type"), F.col("id_no").alias("ctif_id_no"),
        F.col("iss_ctry").alias("ctif_iss_ctry"), "home_addr", F.col("br_no").alias("addr_typ"), "idsy_pfsn",
        F.col("id_no").alias("c_id_no"), F.col("id_type").alias("c_id_type"), F.col("iss_ctry").alias("c_iss_ctry"),
        "cust_nam")
    r = cat.snapshot(OD_REPORT, run).where(norm_date("rpt_dt") == F.lit(run.d)).select(
        "lnpa_loan_typ", F.col("loan_no").cast("string").alias("loan_no"), "od_day_count", "od_prcp", "od_int_day_count", "od_bn_int", "od_bw_int",
        "od_int", "od_od_int_day_count")
    # grouped by join key: the loan key, then the customer key
    j = (loans.join(lb, LOAN_KEY)
         .join(repayment_style(cat, run, loans), LOAN_KEY, "left")
         .join(r, ["lnpa_loan_typ", "loan_no"], "left")
         .join(ii, CUST_KEY).join(c, CUST_KEY)
         .join(customer_totals(cat, run), CUST_KEY, "left"))
    j = _purpose_flag(cat, run, j)
    # only this type's group depends on its collateral; others may have several
    j = j.withColumn("realty_key", F.when(substr1("lnpa_loan_typ", 2) == REALTY_LOAN_TYPE, F.col("loan_no")))
    j = lookup_unique(j, realty_flags(cat, run), {"realty_key": "loan_no"}, ["realty_flag"], name="realty collateral")
    return j.select(*[expr.alias(name) for name, expr in _columns(run).items()])


def _columns(run: RunDate) -> dict[str, Column]:
    typ2 = substr1("lnpa_loan_typ", 2)
    purpose_group = F.when(F.col("pf_is_operate") == "Y", BUSINESS).otherwise(CONSUMER)
    realty_business = (F.col("realty_flag") == "Y") & (substr1("bhdt_bch_cde", 3) == BRANCH_PREFIX)
    fin, fin2 = F.col("fin_insttu"), F.coalesce(F.col("fin_insttu_2"), F.lit("N"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    refinance = F.col("refinc_furchrg_ind")
    return {
        "rpt_dt": F.lit(run.d),
        "loan_no": F.col("loan_no"),
        "loan_typ": F.col("lnpa_loan_typ"),
        "home_addr": F.col("home_addr"),
        "loan_tnr": F.col("loan_tnr"),
        "prps_fin": F.col("prps_fin"),
        "loan_grp": (F.when(typ2.isin(*BUSINESS_TYPES), BUSINESS).when(typ2.isin(*PURPOSE_TYPES), purpose_group)
                     .when(typ2.isin(*CONSUMER_TYPES), CONSUMER)),
        "loan_grp2": (F.when(typ2.isin(*BUSINESS_TYPES), BUSINESS).when(typ2.isin(*PURPOSE_TYPES), purpose_group)
                      .when(typ2 == REALTY_LOAN_TYPE, F.when(realty_business, BUSINESS).otherwise(CONSUMER))
                      .when(typ2.isin("11", "13"), CONSUMER)),
        "addr_typ": F.col("addr_typ"),
        "loan_target": F.col("loan_target"),
        "pay_typ": F.col("pay_typ"),
        "buss_typ": fin,
        "minbuss": (F.when((fin == "6") & (fin2 == "Y"), MINBUSS_SOLE)
                    .when(fin.isin("4", "5") & (fin2 == "Y"), MINBUSS_SMALL).otherwise(MINBUSS_NONE)),
        "idsy_pfsn": F.col("idsy_pfsn"),
        "empr": F.col("empr"),
        "emp_contact_add": F.col("emp_contact_add"),
        "place_orign": F.coalesce(F.col("place_orign"), F.lit("LOCAL")),
        "acct_offcr": F.col("aofr_acct_offcr_cde"),
        "loan_grd": F.col("lb_loan_grd"),
        "os_days": z("lb_os_days"),
        "bch_cde": F.col("bhdt_bch_cde"),
        "id_no": F.col("c_id_no"),
        "id_type": F.col("c_id_type"),
        "iss_ctry": F.col("c_iss_ctry"),
        "cust_nam": F.col("cust_nam"),
        "actv_dt": F.col("actv_dt"),
        "last_due_dt": F.col("last_due_dt"),
        "orig_prcp": F.col("orig_prcp"),
        "os_prcp": F.col("lb_os_prcp"),
        "base_rate": F.col("base_rate"),
        "int_adj_pct": F.col("int_adj_pct"),
        "sprd": F.col("sprd"),
        "main_gur_typ": F.col("main_gur_typ"),
        "recv_int": F.col("lb_recv_int"),
        "susp_int": F.col("lb_susp_int"),
        "od_prcp_day": z("od_day_count"),
        "od_prcp_amt": z("od_prcp"),
        "od_int_day": z("od_int_day_count"),
        "od_int_amt": z("od_bn_int") + z("od_bw_int") - z("od_int"),
        "od_od_int_day": z("od_od_int_day_count"),
        "od_od_int_amt": z("od_int"),
        "sts": F.col("sts"),
        "first_hos": F.col("prod_cde"),
        "inc_hos": F.lit(" "),
        "sum_orig_prcp": z("sum_orig_prcp"),
        "sum_orig_opr": z("sum_orig_opr"),
        "sum_orig_con": z("sum_orig_con"),
        "is_loan_green": F.col("recourse"),
        "loan_target_green": F.col("cust_ref"),
        "loan_ind": F.when(refinance.isNull(), LOAN_IND_NORMAL).otherwise(decode(refinance, LOAN_IND, LOAN_IND_OTHER)),
    }
