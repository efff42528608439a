"""Classifier and expression queries: code sets, prefix rules, decode tables,
status/product/bill derivations, rate text, term arithmetic, address and
remark composition."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendgrid.functions import (
    case_map, coalesce_dates, concat_null_as_empty, decode, effective_rate, in_code_set, money, overdue_days, rate,
    prefix_map, rate_text, term_months as term_months_expr, text_after,
)
from lendgrid.operators import agg_join, first_last_aggs, latest_by, lookup_unique
from lendgrid.plans.frames import LOANS_SQL, RUN, SCHED_SQL, loans, schedule, tables, with_sql
from lendgrid.plans.registry import query

D = RUN.d

# Industry code of a part: two-letter type prefix + two-digit size, e.g. SM05.
# Code sets are generated from a rule (prefix x size range), as the source's
# long literal lists are.
UPGRADE_CODES = [f"{p}{s:02d}" for p in ("SM", "ME", "LA", "PR") for s in range(1, 22)] + ["EC01"]
CULTURE_CODES = [f"{p}{s:02d}" for p in ("EC", "ST", "PR") for s in range(1, 45)]
SMALL_SIZES = (1, 2, 3)


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _code_set_frame(spark: SparkSession, codes: list[str], col: str) -> DataFrame:
    # a literal code list: its size is fixed by construction, so broadcasting
    # it is bounded
    return F.broadcast(spark.createDataFrame([(c,) for c in codes], f"{col} string"))


@query("in_list_flag", f"""
WITH p AS (SELECT p_partkey, upper(substr(p_type, 1, 2)) || lpad(CAST(p_size AS VARCHAR), 2, '0') AS ind_code, p_size FROM part)
SELECT p_partkey AS part_id, ind_code,
  CASE WHEN ind_code IN ({_sql_list(UPGRADE_CODES)}) THEN 'Y' ELSE 'N' END AS upgrade_flg,
  CASE WHEN ind_code IN ({_sql_list(CULTURE_CODES)}) THEN 'Y' ELSE 'N' END AS culture_flg,
  CASE WHEN p_size IN (1, 2, 3) THEN 'Y' ELSE 'N' END AS small_flg
FROM p""")
def in_list_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    p = t.read("part", "p_partkey", "p_type", "p_size").select(
        "p_partkey", "p_size",
        F.concat(F.upper(F.substring("p_type", 1, 2)), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("ind_code"))
    up = _code_set_frame(spark, UPGRADE_CODES, "up_code")
    cu = _code_set_frame(spark, CULTURE_CODES, "cu_code")
    j = p.join(up, F.col("ind_code") == F.col("up_code"), "left").join(cu, F.col("ind_code") == F.col("cu_code"), "left")
    yn = lambda c: F.when(c, "Y").otherwise("N")
    return j.select(F.col("p_partkey").alias("part_id"), "ind_code",
                    yn(F.col("up_code").isNotNull()).alias("upgrade_flg"),
                    yn(F.col("cu_code").isNotNull()).alias("culture_flg"),
                    yn(in_code_set("p_size", SMALL_SIZES)).alias("small_flg"))


@query("like_classify", """
SELECT c_custkey AS cust_id,
  CASE WHEN c_mktsegment LIKE 'AUTO%' THEN 'D01' WHEN c_mktsegment LIKE '%HOLD%' THEN 'D02'
       WHEN c_name NOT LIKE '%00%' THEN 'D03' ELSE 'D99' END AS dept_cd,
  CASE WHEN c_name LIKE 'Customer#0000001%' OR c_name LIKE 'Customer#0000002%' THEN 'entrusted' ELSE 'self' END AS pay_mode,
  CASE WHEN c_mktsegment LIKE '%ING' THEN 'Y' ELSE 'N' END AS loc_flg
FROM customer""")
def like_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).read("customer", "c_custkey", "c_name", "c_mktsegment")
    seg, name = F.col("c_mktsegment"), F.col("c_name")
    dept = case_map([(seg.startswith("AUTO"), "D01"), (seg.contains("HOLD"), "D02"),
                     (~name.contains("00"), "D03")], "D99")
    pay = prefix_map(name, [(("Customer#0000001", "Customer#0000002"), "entrusted")], "self")
    return c.select(F.col("c_custkey").alias("cust_id"), dept.alias("dept_cd"), pay.alias("pay_mode"),
                    F.when(seg.endswith("ING"), "Y").otherwise("N").alias("loc_flg"))


# Decode tables of the demo loan fields.
RATE_TYPE = {"1-URGENT": "RF01", "2-HIGH": "RF02", "3-MEDIUM": "RL01"}
REPAY_FREQ = {"F": "03", "O": "01"}
MAIN_GUARANTEE = {"1": "BCOLL", "2": "COLL", "3": "GUAR", "4": "CREDIT", None: "NONE"}


@query("code_decode", with_sql(LOANS_SQL) + """
SELECT loan_num,
  CASE priority WHEN '1-URGENT' THEN 'RF01' WHEN '2-HIGH' THEN 'RF02' WHEN '3-MEDIUM' THEN 'RL01' ELSE 'RL99' END AS int_rate_typ,
  CASE loan_sts WHEN 'F' THEN '03' WHEN 'O' THEN '01' END AS repay_freq,
  CASE WHEN loan_amt < 50000 THEN '1' WHEN loan_amt < 200000 THEN '2' WHEN loan_amt < 400000 THEN '3' ELSE '99' END AS loan_kind_cd,
  CASE WHEN substr(priority, 1, 1) = '1' THEN 'BCOLL' WHEN substr(priority, 1, 1) = '2' THEN 'COLL'
       WHEN substr(priority, 1, 1) = '3' THEN 'GUAR' WHEN substr(priority, 1, 1) = '4' THEN 'CREDIT'
       WHEN substr(priority, 1, 1) IS NULL THEN 'NONE' END AS main_guaranty_typ
FROM loans""")
def code_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = loans(tables(spark, sf_dir))
    amt = F.col("loan_amt")
    kind = case_map([(amt < 50000, "1"), (amt < 200000, "2"), (amt < 400000, "3")], "99")
    return lo.select("loan_num",
                     decode("priority", RATE_TYPE, "RL99").alias("int_rate_typ"),
                     decode("loan_sts", REPAY_FREQ).alias("repay_freq"),
                     kind.alias("loan_kind_cd"),
                     decode(F.substring("priority", 1, 1), MAIN_GUARANTEE).alias("main_guaranty_typ"))


@query("account_status", with_sql(LOANS_SQL, SCHED_SQL) + """,
a AS (SELECT loan_num, MAX(due_dt) AS last_due_dt,
        MIN(due_dt) FILTER (WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30') AS p_od_dt,
        SUM(prcp_amt) FILTER (WHERE rtn_flag = 'A' AND due_dt <= DATE '1998-06-30') AS paid_prcp
      FROM sched GROUP BY loan_num),
b AS (SELECT l.*, a.last_due_dt, a.paid_prcp,
        CASE WHEN a.p_od_dt IS NOT NULL THEN date_diff('day', a.p_od_dt, DATE '1998-06-30') + 1 ELSE 0 END AS od_days
      FROM loans l LEFT JOIN a ON a.loan_num = l.loan_num)
SELECT loan_num,
  CASE WHEN loan_sts = 'F' THEN '03' WHEN od_days > 90 THEN '02' WHEN od_days > 0 THEN '04' ELSE '01' END AS acct_sts,
  CASE WHEN loan_sts = 'F' THEN last_due_dt END AS finish_dt,
  CASE WHEN loan_sts = 'F' THEN CAST(0 AS DECIMAL(18,2)) ELSE loan_amt - COALESCE(paid_prcp, 0) END AS loan_acct_bal
FROM b""")
def account_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    due = F.col("due_dt") <= F.lit(D)
    j = agg_join(loans(t), schedule(t), ["loan_num"], [
        F.max("due_dt").alias("last_due_dt"),
        F.min(F.when((F.col("rtn_flag") == "N") & due, F.col("due_dt"))).alias("p_od_dt"),
        F.sum(F.when((F.col("rtn_flag") == "A") & due, F.col("prcp_amt"))).alias("paid_prcp"),
    ]).withColumn("od_days", overdue_days(D, "p_od_dt"))
    settled = F.col("loan_sts") == "F"
    od = F.col("od_days")
    sts = F.when(settled, "03").when(od > 90, "02").when(od > 0, "04").otherwise("01")
    bal = F.when(settled, F.lit(0)).otherwise(F.col("loan_amt") - F.coalesce("paid_prcp", F.lit(0))).cast("decimal(38,2)")
    return j.select("loan_num", sts.alias("acct_sts"), F.when(settled, F.col("last_due_dt")).alias("finish_dt"),
                    bal.alias("loan_acct_bal"))


# Product type rules: (part type, exclusive upper size bound) -> code, generated
# as type index x size band; anything unmatched falls back on the price.
PRODUCT_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SIZE_BANDS = (10, 20, 35, 51)
PRODUCT_RULES = [(ty, hi, f"{i + 1:02d}{j + 1:02d}") for i, ty in enumerate(PRODUCT_TYPES[:-1])
                 for j, hi in enumerate(SIZE_BANDS)] + [("STANDARD", 25, "0601"), ("STANDARD", 40, "0602")]


def _product_sql() -> str:
    whens = " ".join(f"WHEN p_type = '{ty}' AND p_size < {hi} THEN '{code}'" for ty, hi, code in PRODUCT_RULES)
    return f"CASE {whens} ELSE CASE WHEN p_retailprice > 1500 THEN '9901' ELSE '9902' END END"


@query("product_type", f"""
SELECT p_partkey AS part_id, {_product_sql()} AS product_type FROM part""")
def product_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = tables(spark, sf_dir).read("part", "p_partkey", "p_type", "p_size", "p_retailprice")
    fallback = F.when(F.col("p_retailprice") > 1500, "9901").otherwise("9902")
    rules = [((F.col("p_type") == ty) & (F.col("p_size") < hi), code) for ty, hi, code in PRODUCT_RULES]
    return p.select(F.col("p_partkey").alias("part_id"), case_map(rules, fallback).alias("product_type"))


@query("bill_status", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT s.loan_num, s.perd_no, s.part_id, s.supp_id,
  CASE s.line_sts WHEN 'F' THEN 'SETL' WHEN 'O' THEN 'ACTV' END AS bill_sts,
  CASE WHEN s.due_dt < DATE '1998-06-30' AND s.line_sts = 'O' THEN 'Y' ELSE 'N' END AS od_flg,
  CASE WHEN s.rtn_flag = 'R' AND (s.due_dt IS NULL OR s.due_dt < l.drawdown_dt + INTERVAL 30 DAY) THEN 'Y' ELSE 'N' END AS sold_flg,
  CAST(s.disc_rate * 100 AS DECIMAL(12,4)) AS sale_rate,
  CAST(s.loan_num AS VARCHAR) || '-' || CAST(s.perd_no AS VARCHAR) AS draft_nbr,
  date_diff('day', l.drawdown_dt, s.due_dt) AS bill_days
FROM sched s JOIN loans l ON l.loan_num = s.loan_num""")
def bill_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    j = schedule(t).join(loans(t).select("loan_num", "drawdown_dt"), "loan_num")
    due = F.col("due_dt")
    sold = (F.col("rtn_flag") == "R") & (due.isNull() | (due < F.date_add("drawdown_dt", 30)))
    return j.select(
        "loan_num", "perd_no", "part_id", "supp_id",
        decode("line_sts", {"F": "SETL", "O": "ACTV"}).alias("bill_sts"),
        F.when((due < F.lit(D)) & (F.col("line_sts") == "O"), "Y").otherwise("N").alias("od_flg"),
        F.when(sold, "Y").otherwise("N").alias("sold_flg"),
        (F.col("disc_rate") * 100).cast("decimal(12,4)").alias("sale_rate"),
        F.concat(F.col("loan_num").cast("string"), F.lit("-"), F.col("perd_no").cast("string")).alias("draft_nbr"),
        F.datediff(due, F.col("drawdown_dt")).cast("bigint").alias("bill_days"))


_LAST_FIRST_SQL = """,
ordered AS (SELECT loan_num, prcp_amt, rtn_flag,
    ROW_NUMBER() OVER (PARTITION BY loan_num ORDER BY perd_no DESC, due_dt DESC, part_id DESC, supp_id DESC, prcp_amt DESC, int_amt DESC) AS rn_last,
    ROW_NUMBER() OVER (PARTITION BY loan_num ORDER BY perd_no, due_dt, part_id, supp_id, prcp_amt, int_amt) AS rn_first
  FROM sched),
t1 AS (SELECT a.loan_num, a.prcp_amt - b.prcp_amt AS pgs_prcp_amt,
         CASE a.rtn_flag WHEN 'A' THEN 'T' WHEN 'R' THEN 'A' WHEN 'N' THEN 'P' END AS repaym_typ
       FROM ordered a JOIN ordered b ON b.loan_num = a.loan_num AND b.rn_first = 1 WHERE a.rn_last = 1),
t2 AS (SELECT loan_num, COUNT(*) AS ip FROM sched WHERE disc_rate = 0 GROUP BY loan_num),
ph AS (SELECT loan_num, COUNT(DISTINCT rtn_flag) AS prcp_freq, COUNT(DISTINCT line_sts) AS int_freq FROM sched GROUP BY loan_num)"""

# The twelve repayment-style labels.
REPAY_STYLES = ("flexible", "combined", "balloon", "step-up", "step-down", "interest-only", "annuity",
                "fixed-installment", "freq-mismatch", "equal-principal", "interest-then-principal", "bullet")


@query("repay_style", with_sql(LOANS_SQL, SCHED_SQL) + _LAST_FIRST_SQL + """
SELECT l.loan_num, CASE
  WHEN l.priority = '1-URGENT' THEN 'flexible'
  WHEN l.loan_sts IN ('O', 'P') THEN
    CASE WHEN l.priority = '2-HIGH' THEN 'combined'
    ELSE CASE
      WHEN l.loan_amt > 450000 THEN 'balloon'
      WHEN COALESCE(t1.pgs_prcp_amt, 0) > 0 THEN 'step-up'
      WHEN COALESCE(t1.pgs_prcp_amt, 0) < 0 THEN 'step-down'
      WHEN COALESCE(t2.ip, 0) = 1 THEN 'interest-only'
      ELSE CASE WHEN COALESCE(t2.ip, 0) = 0 THEN
        CASE WHEN t1.repaym_typ = 'T' THEN 'annuity'
             WHEN t1.repaym_typ = 'A' THEN 'fixed-installment'
             ELSE CASE WHEN t1.repaym_typ = 'P' THEN
               CASE WHEN COALESCE(ph.prcp_freq, 0) <> COALESCE(ph.int_freq, 1) THEN 'freq-mismatch'
                    ELSE 'equal-principal' END END END END END END
  ELSE CASE WHEN COALESCE(t2.ip, 0) > 0 THEN 'interest-then-principal' ELSE 'bullet' END
  END AS repayment_typ
FROM loans l JOIN t1 ON t1.loan_num = l.loan_num
LEFT JOIN t2 ON t2.loan_num = l.loan_num
LEFT JOIN ph ON ph.loan_num = l.loan_num""")
def repay_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one aggregate over the schedule: first and last line per loan (min /
    # max of a struct), interest-only count and distinct flag counts
    t = tables(spark, sf_dir)
    s = schedule(t)
    tie = ["perd_no", "due_dt", "part_id", "supp_id", "prcp_amt", "int_amt"]
    per_loan = s.groupBy("loan_num").agg(
        *first_last_aggs(tie, ["prcp_amt", "rtn_flag"]),
        F.count(F.when(F.col("disc_rate") == 0, 1)).alias("ip_n"),
        F.size(F.collect_set("rtn_flag")).alias("prcp_freq"), F.size(F.collect_set("line_sts")).alias("int_freq"))
    agg = per_loan.select(
        "loan_num", (F.col("last.prcp_amt") - F.col("first.prcp_amt")).alias("pgs"),
        decode(F.col("last.rtn_flag"), {"A": "T", "R": "A", "N": "P"}).alias("repaym_typ"),
        "ip_n", "prcp_freq", "int_freq")
    j = loans(t).join(agg, "loan_num")
    ip = F.when(F.col("ip_n") > 0, F.col("ip_n"))  # no IO lines = no T2 row
    ip0 = F.coalesce(ip, F.lit(0))
    pgs = F.coalesce(F.col("pgs"), F.lit(0))
    rt = F.col("repaym_typ")
    by_type = (F.when(rt == "T", "annuity").when(rt == "A", "fixed-installment")
               .when(rt == "P", F.when(F.coalesce("prcp_freq", F.lit(0)) != F.coalesce("int_freq", F.lit(1)),
                                       "freq-mismatch").otherwise("equal-principal")))
    inner = (F.when(F.col("loan_amt") > 450000, "balloon").when(pgs > 0, "step-up").when(pgs < 0, "step-down")
             .when(ip0 == 1, "interest-only").when(ip0 == 0, by_type))
    style = (F.when(F.col("priority") == "1-URGENT", "flexible")
             .when(F.col("loan_sts").isin("O", "P"), F.when(F.col("priority") == "2-HIGH", "combined").otherwise(inner))
             .otherwise(F.when(ip0 > 0, "interest-then-principal").otherwise("bullet")))
    return j.select("loan_num", style.alias("repayment_typ"))


@query("rate_format", with_sql(LOANS_SQL) + """,
r AS (SELECT l_orderkey AS loan_num, MAX(CAST(l_tax AS DECIMAL(18,2))) * 100 AS base_rate,
             MAX(CAST(l_discount AS DECIMAL(18,2))) * 10 AS spread FROM lineitem GROUP BY l_orderkey)
SELECT l.loan_num,
  CASE WHEN l.priority LIKE '5%' THEN NULL ELSE CAST(CAST(r.base_rate AS DECIMAL(24,5)) AS VARCHAR) END AS base_int_rat,
  CAST(CAST(r.base_rate + r.spread AS DECIMAL(24,5)) AS VARCHAR) AS real_int_rat
FROM loans l JOIN r ON r.loan_num = l.loan_num""")
def rate_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    r = t.read("lineitem", "l_orderkey", "l_tax", "l_discount").groupBy(F.col("l_orderkey").alias("loan_num")).agg(
        (F.max(money("l_tax")) * 100).alias("base_rate"), (F.max(money("l_discount")) * 10).alias("spread"))
    j = loans(t).join(r, "loan_num")
    return j.select("loan_num",
                    F.when(F.col("priority").like("5%"), F.lit(None).cast("string"))
                    .otherwise(rate_text("base_rate")).alias("base_int_rat"),
                    rate_text(F.col("base_rate") + F.col("spread")).alias("real_int_rat"))


@query("effective_rate", """
SELECT l_orderkey AS loan_num, l_linenumber AS perd_no,
  CAST((CAST(CAST(l_tax AS DECIMAL(18,2)) * 100 AS DECIMAL(12,8))
        + CAST(NULLIF(CAST(l_discount AS DECIMAL(18,2)), 0.05) * 10 AS DECIMAL(12,8)))
       * (1 + CAST(NULLIF(CAST(l_quantity AS DECIMAL(12,6)), 7) AS DECIMAL(12,6)) * 0.01) AS DECIMAL(30,16)) AS real_int_rat
FROM lineitem""")
def effective_rate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    # some discounts and quantities are taken as unknown, so that rates with a NULL part occur
    li = tables(spark, sf_dir).read("lineitem", "l_orderkey", "l_linenumber", "l_tax", "l_discount", "l_quantity")
    spread = F.nullif(money("l_discount"), F.lit(Decimal("0.05")))
    adj = F.nullif(rate("l_quantity"), F.lit(Decimal(7)))
    return li.select(F.col("l_orderkey").alias("loan_num"), F.col("l_linenumber").alias("perd_no"),
                     effective_rate(money("l_tax") * 100, spread * 10, adj).alias("real_int_rat"))


@query("term_months", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT s.loan_num, s.perd_no, date_diff('day', l.drawdown_dt, s.due_dt) AS term_days,
  (year(s.due_dt) - year(l.drawdown_dt)) * 12 + month(s.due_dt) - month(l.drawdown_dt)
  + CASE WHEN day(s.due_dt) = day(l.drawdown_dt) OR (s.due_dt = last_day(s.due_dt) AND l.drawdown_dt = last_day(l.drawdown_dt)) THEN 0
         WHEN day(s.due_dt) > day(l.drawdown_dt) THEN 1 ELSE 0 END AS orig_term
FROM sched s JOIN loans l ON l.loan_num = s.loan_num""")
def term_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ceil(months_between(end, start)): the oracle spells out the same
    # calendar rule (whole months, +1 for a partial month forward)
    t = tables(spark, sf_dir)
    j = schedule(t).join(loans(t).select("loan_num", "drawdown_dt"), "loan_num")
    return j.select("loan_num", "perd_no", F.datediff("due_dt", "drawdown_dt").cast("bigint").alias("term_days"),
                    term_months_expr("drawdown_dt", "due_dt").cast("bigint").alias("orig_term"))


@query("coalesce_dates", with_sql(LOANS_SQL, SCHED_SQL) + """,
a AS (SELECT loan_num, MIN(due_dt) FILTER (WHERE due_dt > DATE '1998-06-30') AS next_due,
        MIN(due_dt) FILTER (WHERE rtn_flag = 'R' AND due_dt > DATE '1998-06-30') AS next_r,
        MAX(due_dt) AS maturity_dt FROM sched GROUP BY loan_num)
SELECT l.loan_num, COALESCE(a.next_r, a.next_due, a.maturity_dt) AS next_repricing_dt,
  CASE WHEN l.priority LIKE '1%' THEN LEAST(a.maturity_dt, a.next_due) ELSE a.maturity_dt END AS repc_dt,
  a.maturity_dt
FROM loans l LEFT JOIN a ON a.loan_num = l.loan_num""")
def coalesce_dates_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    after = F.col("due_dt") > F.lit(D)
    j = agg_join(loans(t), schedule(t), ["loan_num"], [
        F.min(F.when(after, F.col("due_dt"))).alias("next_due"),
        F.min(F.when(after & (F.col("rtn_flag") == "R"), F.col("due_dt"))).alias("next_r"),
        F.max("due_dt").alias("maturity_dt")])
    repc = F.when(F.col("priority").like("1%"), F.least("maturity_dt", "next_due")).otherwise(F.col("maturity_dt"))
    return j.select("loan_num", coalesce_dates("next_r", "next_due", "maturity_dt").alias("next_repricing_dt"),
                    repc.alias("repc_dt"), "maturity_dt")


@query("address_compose", with_sql(LOANS_SQL) + """,
latest AS (SELECT cust_id, priority FROM (
  SELECT cust_id, priority, ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY drawdown_dt DESC, loan_num DESC) AS rn
  FROM loans) WHERE rn = 1)
SELECT c.c_custkey AS cust_id,
  concat_ws('', (SELECT n.n_name FROM nation n WHERE n.n_nationkey = c.c_nationkey), ' ',
                (SELECT r.r_name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey WHERE n.n_nationkey = c.c_nationkey),
                ' ', lt.priority) AS home_addr
FROM customer c LEFT JOIN latest lt ON lt.cust_id = c.c_custkey""")
def address_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    c = t.read("customer", "c_custkey", "c_nationkey")
    names = (t.read("nation", "n_nationkey", "n_name", "n_regionkey")
             .join(t.read("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
             .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"))
    c = lookup_unique(c, names, ["c_nationkey"], ["n_name", "r_name"], name="nation names")
    latest = latest_by(loans(t), ["cust_id"], [F.col("drawdown_dt").desc(), F.col("loan_num").desc()]).select(
        F.col("cust_id").alias("c_custkey"), "priority")
    j = c.join(latest, "c_custkey", "left")
    addr = concat_null_as_empty("n_name", F.lit(" "), "r_name", F.lit(" "), "priority")
    return j.select(F.col("c_custkey").alias("cust_id"), addr.alias("home_addr"))


@query("remark_extract", """
SELECT c_custkey AS cust_id,
  CASE WHEN c_acctbal > 0 THEN concat_ws('', c_mktsegment,
        CASE WHEN length(substr(c_name, instr(c_name, '#') + 1)) = 0 THEN NULL ELSE substr(c_name, instr(c_name, '#') + 1) END)
       ELSE '' END AS remark,
  CASE WHEN length(substr(c_mktsegment, instr(c_mktsegment, ']') + 1)) = 0 THEN NULL
       ELSE substr(c_mktsegment, instr(c_mktsegment, ']') + 1) END AS no_marker
FROM customer""")
def remark_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).read("customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    remark = F.when(F.col("c_acctbal") > 0, concat_null_as_empty("c_mktsegment", text_after("c_name", "#"))).otherwise("")
    return c.select(F.col("c_custkey").alias("cust_id"), remark.alias("remark"),
                    text_after("c_mktsegment", "]").alias("no_marker"))
