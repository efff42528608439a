"""Join-shaped queries: enrichment chains, role-playing dimensions, inner
chains, computed and null-safe keys, membership flags, set operations and
key-checked lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendgrid.functions import money_sum
from lendgrid.operators import (
    Lookup, attach_many, code_map, coalesce_lookup, exists_flag, having_multi, lookup_unique,
    membership_flag, split_left_join,
)
from lendgrid.plans.frames import (
    EV_RUN, HIST_SQL, LOANS_SQL, RUN, SCHED_SQL, hist, loans, schedule, tables, with_sql,
)
from lendgrid.plans.registry import query
from lendgrid.sources import as_of, dated_dim, event_window

D = RUN.d


def _nation(t, *cols):
    return t.read("nation", *cols)


def _region(t, *cols):
    return t.read("region", *cols)


@query("enrich_left", with_sql(LOANS_SQL) + """
SELECT l.loan_num, c.c_name AS cust_nam, CAST(c.c_acctbal AS DECIMAL(18,2)) AS cust_bal, n.n_name AS nation_nam
FROM loans l
LEFT JOIN customer c ON c.c_custkey = l.cust_id AND c.c_acctbal > 0
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    # constant predicate of the ON clause = filter the dimension before the join
    c = t.read("customer", "c_custkey", "c_name", "c_acctbal", "c_nationkey").where(F.col("c_acctbal") > 0)
    n = _nation(t, "n_nationkey", "n_name")
    j = (loans(t).join(c, F.col("cust_id") == c.c_custkey, "left")
         .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    return j.select("loan_num", F.col("c_name").alias("cust_nam"),
                    F.col("c_acctbal").cast("decimal(18,2)").alias("cust_bal"), F.col("n_name").alias("nation_nam"))


@query("composite_join", with_sql(SCHED_SQL) + """,
pair AS (SELECT part_id, supp_id, COUNT(*) AS pair_lines, SUM(prcp_amt) AS pair_prcp FROM sched GROUP BY part_id, supp_id)
SELECT s.loan_num, s.perd_no, s.part_id, s.supp_id, p.pair_lines, p.pair_prcp
FROM sched s LEFT JOIN pair p ON p.part_id = s.part_id AND p.supp_id = s.supp_id""")
def composite_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = schedule(tables(spark, sf_dir)).select("loan_num", "perd_no", "part_id", "supp_id", "prcp_amt")
    pair = s.groupBy("part_id", "supp_id").agg(F.count(F.lit(1)).alias("pair_lines"),
                                              money_sum("prcp_amt").alias("pair_prcp"))
    return s.join(pair, ["part_id", "supp_id"], "left").select(
        "loan_num", "perd_no", "part_id", "supp_id", "pair_lines", "pair_prcp")


@query("role_playing_dim", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT cn.n_name AS cust_nation, sn.n_name AS supp_nation, COUNT(*) AS n_lines, SUM(s.prcp_amt) AS prcp_sum
FROM sched s
JOIN loans l ON l.loan_num = s.loan_num
LEFT JOIN customer c ON c.c_custkey = l.cust_id
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
LEFT JOIN supplier su ON su.s_suppkey = s.supp_id
LEFT JOIN nation sn ON sn.n_nationkey = su.s_nationkey
GROUP BY cn.n_name, sn.n_name""")
def role_playing_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    cn = _nation(t, "n_nationkey", "n_name").toDF("cn_key", "cust_nation")
    sn = _nation(t, "n_nationkey", "n_name").toDF("sn_key", "supp_nation")
    c = t.read("customer", "c_custkey", "c_nationkey")
    su = t.read("supplier", "s_suppkey", "s_nationkey")
    j = (schedule(t).select("loan_num", "supp_id", "prcp_amt")
         .join(loans(t).select("loan_num", "cust_id"), "loan_num")
         .join(c, F.col("cust_id") == c.c_custkey, "left")
         .join(cn, F.col("c_nationkey") == F.col("cn_key"), "left")
         .join(su, F.col("supp_id") == su.s_suppkey, "left")
         .join(sn, F.col("s_nationkey") == F.col("sn_key"), "left"))
    return j.groupBy("cust_nation", "supp_nation").agg(F.count(F.lit(1)).alias("n_lines"),
                                                       money_sum("prcp_amt").alias("prcp_sum"))


@query("chain_enrich", with_sql(LOANS_SQL) + """
SELECT l.loan_num, n.n_name AS cust_nation, r.r_name AS region_nam,
       COALESCE(r.r_name, n.n_name, 'UNKNOWN') AS area_nam
FROM loans l
LEFT JOIN customer c ON c.c_custkey = l.cust_id
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey AND r.r_regionkey <> 4""")
def chain_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    # each join's key comes from the previous join's output
    t = tables(spark, sf_dir)
    c = t.read("customer", "c_custkey", "c_nationkey")
    n = _nation(t, "n_nationkey", "n_name", "n_regionkey")
    r = _region(t, "r_regionkey", "r_name").where(F.col("r_regionkey") != 4)
    j = (loans(t).join(c, F.col("cust_id") == c.c_custkey, "left")
         .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
         .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    return j.select("loan_num", F.col("n_name").alias("cust_nation"), F.col("r_name").alias("region_nam"),
                    F.coalesce("r_name", "n_name", F.lit("UNKNOWN")).alias("area_nam"))


@query("dated_dim_join", with_sql(HIST_SQL) + """,
daily AS (SELECT user_id, strftime(CAST(ts AS DATE), '%Y%m%d') AS data_date, COUNT(*) AS day_events,
                 SUM(CAST(value AS DECIMAL(18,2))) AS day_value
          FROM events GROUP BY user_id, strftime(CAST(ts AS DATE), '%Y%m%d'))
SELECT h.user_id, h.event_type, d.day_events, d.day_value
FROM hist h LEFT JOIN daily d ON d.user_id = h.user_id AND d.data_date = '20240115'
WHERE h.begndt <= DATE '2024-01-15' AND h.overdt > DATE '2024-01-15' AND h.partid = '202401'""")
def dated_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    ev = t.read("events", "user_id", "ts", "value")
    daily = ev.groupBy("user_id", F.date_format(F.to_date("ts"), "yyyyMMdd").alias("data_date")).agg(
        F.count(F.lit(1)).alias("day_events"), money_sum(F.col("value").cast("decimal(18,2)")).alias("day_value"))
    daily = dated_dim(daily, EV_RUN).drop("data_date")
    snap = as_of(hist(t), EV_RUN).select("user_id", "event_type")
    return snap.join(daily, "user_id", "left").select("user_id", "event_type", "day_events", "day_value")


@query("comma_inner", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT c.c_mktsegment AS segment, COUNT(*) AS n_lines, SUM(s.prcp_amt) AS prcp_sum
FROM loans l, sched s, customer c
WHERE s.loan_num = l.loan_num AND c.c_custkey = l.cust_id AND s.rtn_flag = 'R'
GROUP BY c.c_mktsegment""")
def comma_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    c = t.read("customer", "c_custkey", "c_mktsegment")
    j = (loans(t).join(schedule(t).where(F.col("rtn_flag") == "R"), "loan_num")
         .join(c, F.col("cust_id") == c.c_custkey))
    return j.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n_lines"), money_sum("prcp_amt").alias("prcp_sum"))


@query("bill_inner_chain", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT l.loan_num, COUNT(*) AS n_lines, SUM(s.prcp_amt) AS prcp_sum
FROM loans l
INNER JOIN sched s ON s.loan_num = l.loan_num
INNER JOIN part p ON p.p_partkey = s.part_id
INNER JOIN supplier su ON su.s_suppkey = s.supp_id
WHERE p.p_size > 20 AND su.s_acctbal > 0 AND l.loan_sts = 'F'
GROUP BY l.loan_num""")
def bill_inner_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    p = t.read("part", "p_partkey", "p_size").where(F.col("p_size") > 20)
    su = t.read("supplier", "s_suppkey", "s_acctbal").where(F.col("s_acctbal") > 0)
    j = (loans(t).where(F.col("loan_sts") == "F").join(schedule(t), "loan_num")
         .join(p, F.col("part_id") == p.p_partkey).join(su, F.col("supp_id") == su.s_suppkey))
    return j.groupBy("loan_num").agg(F.count(F.lit(1)).alias("n_lines"), money_sum("prcp_amt").alias("prcp_sum"))


@query("detail_assemble", with_sql(LOANS_SQL, SCHED_SQL) + """,
od AS (SELECT loan_num, SUM(prcp_amt) AS od_prcp_amt FROM sched
       WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30' GROUP BY loan_num),
ytd AS (SELECT l.cust_id, SUM(s.int_amt) AS cust_ytd_int FROM loans l JOIN sched s ON s.loan_num = l.loan_num
        WHERE s.due_dt BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' GROUP BY l.cust_id),
last AS (SELECT loan_num, MAX(due_dt) AS last_due_dt FROM sched GROUP BY loan_num)
SELECT l.loan_num, c.c_name AS cust_nam, n.n_name AS nation_nam, od.od_prcp_amt, ytd.cust_ytd_int, last.last_due_dt
FROM loans l
JOIN customer c ON c.c_custkey = l.cust_id
JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN od ON od.loan_num = l.loan_num
LEFT JOIN ytd ON ytd.cust_id = l.cust_id
LEFT JOIN last ON last.loan_num = l.loan_num
WHERE l.loan_sts <> 'F'""")
def detail_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    s = schedule(t)
    lo = loans(t).where(F.col("loan_sts") != "F")
    od = (s.where((F.col("rtn_flag") == "N") & (F.col("due_dt") <= F.lit(D)))
          .groupBy("loan_num").agg(money_sum("prcp_amt").alias("od_prcp_amt")))
    ytd = (loans(t).join(event_window(s, "due_dt", RUN.year_start, D, raw_ts="due_ts"), "loan_num")
           .groupBy("cust_id").agg(money_sum("int_amt").alias("cust_ytd_int")))
    last = s.groupBy("loan_num").agg(F.max("due_dt").alias("last_due_dt"))
    c = t.read("customer", "c_custkey", "c_name", "c_nationkey")
    n = _nation(t, "n_nationkey", "n_name")
    j = (lo.join(c, F.col("cust_id") == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
         .join(od, "loan_num", "left").join(ytd, "cust_id", "left").join(last, "loan_num", "left"))
    return j.select("loan_num", F.col("c_name").alias("cust_nam"), F.col("n_name").alias("nation_nam"),
                    "od_prcp_amt", "cust_ytd_int", "last_due_dt")


@query("computed_key_join", with_sql(LOANS_SQL) + """
SELECT l.loan_num, n.n_name AS org_nation_nam, su.s_name AS twin_supplier
FROM loans l
LEFT JOIN customer c ON c.c_custkey = l.cust_id
LEFT JOIN nation n ON n.n_nationkey = CASE WHEN c.c_nationkey = 0 THEN 1 ELSE c.c_nationkey END
LEFT JOIN supplier su ON substr(su.s_name, 10) = substr(c.c_name, 10)""")
def computed_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # keys are derived columns, so each join is still an equi join (hash
    # partitioned / broadcast), not a nested-loop theta join
    t = tables(spark, sf_dir)
    c = t.read("customer", "c_custkey", "c_nationkey", "c_name").select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 0, F.lit(1)).otherwise(F.col("c_nationkey")).alias("org_key"),
        F.expr("substring(c_name, 10)").alias("name_key"))
    n = _nation(t, "n_nationkey", "n_name")
    su = t.read("supplier", "s_name").select("s_name", F.expr("substring(s_name, 10)").alias("s_key"))
    j = (loans(t).join(c, F.col("cust_id") == c.c_custkey, "left")
         .join(n, F.col("org_key") == n.n_nationkey, "left")
         .join(su, F.col("name_key") == F.col("s_key"), "left"))
    return j.select("loan_num", F.col("n_name").alias("org_nation_nam"), F.col("s_name").alias("twin_supplier"))


@query("nullsafe_join", with_sql(LOANS_SQL, SCHED_SQL) + """,
od AS (SELECT l.loan_num, l.cust_id, MIN(s.due_dt) FILTER (WHERE s.rtn_flag = 'N' AND s.due_dt <= DATE '1998-06-30') AS p_od_dt
       FROM loans l LEFT JOIN sched s ON s.loan_num = l.loan_num GROUP BY l.loan_num, l.cust_id),
m AS (SELECT cust_id, MIN(p_od_dt) AS min_p_od_dt FROM od GROUP BY cust_id)
SELECT od.loan_num, od.p_od_dt, CASE WHEN m.cust_id IS NOT NULL THEN 'Y' ELSE 'N' END AS is_cust_earliest
FROM od LEFT JOIN m ON m.cust_id = od.cust_id AND od.p_od_dt IS NOT DISTINCT FROM m.min_p_od_dt""")
def nullsafe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    unpaid = (F.col("rtn_flag") == "N") & (F.col("due_dt") <= F.lit(D))
    od = (loans(t).select("loan_num", "cust_id").join(schedule(t), "loan_num", "left")
          .groupBy("loan_num", "cust_id").agg(F.min(F.when(unpaid, F.col("due_dt"))).alias("p_od_dt")))
    m = od.groupBy(F.col("cust_id").alias("m_cust")).agg(F.min("p_od_dt").alias("min_p_od_dt"))
    j = od.join(m, (F.col("m_cust") == F.col("cust_id")) & F.col("p_od_dt").eqNullSafe(F.col("min_p_od_dt")), "left")
    return j.select("loan_num", "p_od_dt",
                    F.when(F.col("m_cust").isNotNull(), "Y").otherwise("N").alias("is_cust_earliest"))


@query("membership_flag", with_sql(LOANS_SQL, SCHED_SQL) + """,
ids AS (SELECT loan_num AS id FROM sched WHERE rtn_flag = 'R'
        UNION SELECT loan_num FROM loans WHERE loan_amt > 400000
        UNION SELECT l.loan_num FROM loans l JOIN customer c ON c.c_custkey = l.cust_id WHERE c.c_mktsegment = 'AUTOMOBILE')
SELECT l.loan_num, CASE WHEN ids.id IS NOT NULL THEN 'Y' ELSE 'N' END AS in_registry
FROM loans l LEFT JOIN ids ON ids.id = l.loan_num""")
def membership_flag_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    lo = loans(t)
    c = t.read("customer", "c_custkey", "c_mktsegment").where(F.col("c_mktsegment") == "AUTOMOBILE")
    sets = [
        schedule(t).where(F.col("rtn_flag") == "R").select("loan_num"),
        lo.where(F.col("loan_amt") > 400000).select("loan_num"),
        lo.join(c, F.col("cust_id") == c.c_custkey).select("loan_num"),
    ]
    return membership_flag(lo.select("loan_num"), "loan_num", sets, "in_registry")


@query("exists_flag", with_sql(LOANS_SQL) + """
SELECT loan_num, CASE WHEN cust_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'Y' ELSE 'N' END AS neg_bal_cust
FROM loans""")
def exists_flag_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    neg = t.read("customer", "c_custkey", "c_acctbal").where(F.col("c_acctbal") < 0)
    return exists_flag(loans(t).select("loan_num", "cust_id"), "cust_id", neg, "c_custkey",
                       "neg_bal_cust").select("loan_num", "neg_bal_cust")


_GUAR_SQL = """,
g AS (SELECT DISTINCT s.loan_num, p.p_type FROM sched s JOIN part p ON p.p_partkey = s.part_id)"""


def _guarantees(t) -> DataFrame:
    p = t.read("part", "p_partkey", "p_type")
    return (schedule(t).select("loan_num", "part_id").join(p, F.col("part_id") == p.p_partkey)
            .select("loan_num", "p_type").distinct())


@query("having_multi", with_sql(SCHED_SQL) + _GUAR_SQL + """
SELECT loan_num, substr(p_type, 1, 1) AS type_group, COUNT(*) AS n_types
FROM g GROUP BY loan_num, substr(p_type, 1, 1) HAVING COUNT(*) > 1""")
def having_multi_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _guarantees(tables(spark, sf_dir)).withColumn("type_group", F.substring("p_type", 1, 1))
    return having_multi(g, ["loan_num", "type_group"], 2, "n_types")


@query("dedupe_guard", with_sql(SCHED_SQL) + _GUAR_SQL + """,
multi AS (SELECT loan_num FROM g GROUP BY loan_num HAVING COUNT(*) > 1)
SELECT g.loan_num, g.p_type FROM g LEFT JOIN multi m ON m.loan_num = g.loan_num
WHERE m.loan_num IS NULL OR g.p_type = 'PROMO'""")
def dedupe_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    # loans with several guarantee kinds keep only the real-estate one
    g = _guarantees(tables(spark, sf_dir))
    multi = having_multi(g, ["loan_num"], 2).select(F.col("loan_num").alias("m_loan"))
    j = g.join(multi, F.col("m_loan") == F.col("loan_num"), "left")
    return j.where(F.col("m_loan").isNull() | (F.col("p_type") == "PROMO")).select("loan_num", "p_type")


@query("distinct_keys", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT DISTINCT l.cust_id, s.rtn_flag FROM loans l JOIN sched s ON s.loan_num = l.loan_num""")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return loans(t).join(schedule(t), "loan_num").select("cust_id", "rtn_flag").distinct()


@query("union_distinct", with_sql(LOANS_SQL) + """
SELECT CAST(loan_num AS VARCHAR) AS loan_key, priority AS loan_grd, loan_amt AS os_prcp FROM loans WHERE loan_sts = 'O'
UNION
SELECT CAST(loan_num AS VARCHAR), priority, CAST(0 AS DECIMAL(18,2)) FROM loans
WHERE loan_sts = 'F' AND drawdown_dt >= DATE '1998-01-01' AND drawdown_dt <= DATE '1998-06-30'""")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = loans(tables(spark, sf_dir))
    a = lo.where(F.col("loan_sts") == "O").select(
        F.col("loan_num").cast("string").alias("loan_key"), F.col("priority").alias("loan_grd"),
        F.col("loan_amt").alias("os_prcp"))
    b = lo.where((F.col("loan_sts") == "F") & F.col("drawdown_dt").between(F.lit(RUN.year_start), F.lit(D))).select(
        F.col("loan_num").cast("string").alias("loan_key"), F.col("priority").alias("loan_grd"),
        F.lit(0).cast("decimal(18,2)").alias("os_prcp"))
    return a.unionByName(b).distinct()


@query("scalar_lookup", """
SELECT c.c_custkey AS cust_id,
  (SELECT n.n_name FROM nation n WHERE n.n_nationkey = c.c_nationkey) AS nation_nam,
  (SELECT n.n_regionkey FROM nation n WHERE n.n_nationkey = c.c_nationkey) AS region_key
FROM customer c""")
def scalar_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    c = t.read("customer", "c_custkey", "c_nationkey")
    n = t.read("nation", "n_nationkey", "n_name", "n_regionkey").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation_nam"),
        F.col("n_regionkey").alias("region_key"))
    j = lookup_unique(c, n, ["c_nationkey"], ["nation_nam", "region_key"], name="nation")
    return j.select(F.col("c_custkey").alias("cust_id"), "nation_nam", "region_key")


@query("scalar_lookup_chain", """
SELECT s.s_suppkey AS supp_id,
  (SELECT r.r_name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
   WHERE n.n_nationkey = s.s_nationkey) AS region_nam
FROM supplier s""")
def scalar_lookup_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    chain = (_nation(t, "n_nationkey", "n_regionkey")
             .join(_region(t, "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
             .select(F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("region_nam")))
    s = t.read("supplier", "s_suppkey", "s_nationkey")
    j = lookup_unique(s, chain, ["s_nationkey"], ["region_nam"], name="supplier region")
    return j.select(F.col("s_suppkey").alias("supp_id"), "region_nam")


@query("coalesce_lookup", with_sql(LOANS_SQL) + """
SELECT l.loan_num, COALESCE(c.c_name, s.s_name) AS acct_name
FROM loans l
LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000) c ON c.c_custkey = l.cust_id
LEFT JOIN supplier s ON s.s_suppkey = l.cust_id""")
def coalesce_lookup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    rich = t.read("customer", "c_custkey", "c_name", "c_acctbal").where(F.col("c_acctbal") > 5000)
    su = t.read("supplier", "s_suppkey", "s_name")
    j = coalesce_lookup(loans(t).select("loan_num", "cust_id"), "cust_id",
                        [(rich, "c_custkey", "c_name"), (su, "s_suppkey", "s_name")], "acct_name")
    return j.select("loan_num", "acct_name")


def code_table(t) -> DataFrame:
    """Code map ``(business_type, dict_code, ori_values, new_values)`` derived
    from the reference dimensions; codes may carry a trailing ``%``."""
    n = t.read("nation", "n_nationkey", "n_name").select(
        F.lit("RSUM").alias("business_type"), F.lit("NATION").alias("dict_code"),
        F.col("n_nationkey").cast("string").alias("ori_values"), F.col("n_name").alias("new_values"))
    r = t.read("region", "r_regionkey", "r_name").select(
        F.lit("RSUM").alias("business_type"), F.lit("REGION").alias("dict_code"),
        F.concat(F.col("r_regionkey").cast("string"), F.lit("%")).alias("ori_values"),
        F.col("r_name").alias("new_values"))
    return n.unionByName(r)


CODE_TABLE_SQL = """codes AS (
  SELECT 'RSUM' AS business_type, 'NATION' AS dict_code, CAST(n_nationkey AS VARCHAR) AS ori_values, n_name AS new_values FROM nation
  UNION ALL
  SELECT 'RSUM', 'REGION', CAST(r_regionkey AS VARCHAR) || '%', r_name FROM region)"""


@query("code_map", with_sql(CODE_TABLE_SQL) + """,
cn AS (SELECT c.c_custkey, c.c_nationkey, n.n_regionkey FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)
SELECT cn.c_custkey AS cust_id, COALESCE(m1.new_values, 'UNKNOWN') AS nation_cd_nam, m2.new_values AS region_cd_nam
FROM cn
LEFT JOIN codes m1 ON m1.business_type = 'RSUM' AND m1.dict_code = 'NATION' AND m1.ori_values = CAST(cn.c_nationkey AS VARCHAR)
LEFT JOIN codes m2 ON m2.business_type = 'RSUM' AND m2.dict_code = 'REGION'
                  AND REPLACE(m2.ori_values, '%', '') = CAST(cn.n_regionkey AS VARCHAR)""")
def code_map_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    codes = code_table(t).where(F.col("business_type") == "RSUM")
    codes = codes.withColumn("ori_values", F.replace("ori_values", F.lit("%"), F.lit("")))
    c = t.read("customer", "c_custkey", "c_nationkey").join(
        _nation(t, "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    j = code_map(c, F.col("c_nationkey").cast("string"), codes, "NATION", "nation_cd_nam", default=F.lit("UNKNOWN"))
    j = code_map(j, F.col("n_regionkey").cast("string"), codes, "REGION", "region_cd_nam")
    return j.select(F.col("c_custkey").alias("cust_id"), "nation_cd_nam", "region_cd_nam")


@query("filter_tree", with_sql(LOANS_SQL, SCHED_SQL) + """,
e AS (SELECT loan_num, MIN(due_dt) AS earliest_unpaid_dt FROM sched
      WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30' GROUP BY loan_num)
SELECT l.loan_num, l.loan_sts, l.priority
FROM loans l LEFT JOIN e ON e.loan_num = l.loan_num
WHERE (l.loan_sts <> 'F' AND (l.priority LIKE '1%' OR l.priority LIKE '2%'))
   OR (l.loan_amt > 300000 AND NOT l.priority = '5-LOW' AND l.loan_sts != 'O')
   OR (CASE WHEN l.loan_sts = 'P' THEN e.earliest_unpaid_dt END) IS NOT NULL""")
def filter_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    e = (schedule(t).where((F.col("rtn_flag") == "N") & (F.col("due_dt") <= F.lit(D)))
         .groupBy("loan_num").agg(F.min("due_dt").alias("earliest_unpaid_dt")))
    j = loans(t).join(e, "loan_num", "left")
    sts, pri = F.col("loan_sts"), F.col("priority")
    cond = (((sts != "F") & (pri.like("1%") | pri.like("2%")))
            | ((F.col("loan_amt") > 300000) & ~(pri == "5-LOW") & (sts != "O"))
            | F.when(sts == "P", F.col("earliest_unpaid_dt")).isNotNull())
    return j.where(cond).select("loan_num", "loan_sts", "priority")


@query("attach_many", with_sql(SCHED_SQL) + """,
asks AS (SELECT *, CASE WHEN perd_no <= 3 THEN supp_id END AS payee_id FROM sched),
pair AS (SELECT part_id, supp_id, COUNT(*) AS pair_lines, SUM(prcp_amt) AS pair_prcp FROM sched GROUP BY part_id, supp_id),
drawn AS (SELECT o_custkey, COUNT(*) AS cust_loans FROM orders GROUP BY o_custkey),
j AS (SELECT a.loan_num, a.perd_no, o.o_custkey AS cust_id, o.o_orderstatus AS loan_sts, p.p_brand AS part_brand, s.s_name AS payee_nam, s.s_nationkey,
        pair_lines, pair_prcp
      FROM asks a LEFT JOIN orders o ON o.o_orderkey = a.loan_num AND o.o_orderpriority <> '5-LOW' LEFT JOIN part p ON p.p_partkey = a.part_id
      LEFT JOIN supplier s ON s.s_suppkey = a.payee_id LEFT JOIN pair ON pair.part_id = a.part_id AND pair.supp_id = a.payee_id)
SELECT loan_num, perd_no, cust_id, loan_sts, part_brand, payee_nam, pair_lines, pair_prcp, c.c_mktsegment AS cust_segment, cust_loans, n.n_name AS payee_nation
FROM j LEFT JOIN customer c ON c.c_custkey = j.cust_id LEFT JOIN drawn d ON d.o_custkey = j.cust_id LEFT JOIN nation n ON n.n_nationkey = j.s_nationkey""")
def attach_many_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven look-ups on six keys, two levels deep: the lines of the schedule are shuffled twice
    as wide rows, not once for every key."""
    t = tables(spark, sf_dir)
    s = schedule(t).select("loan_num", "perd_no", "part_id", "supp_id", "prcp_amt")
    lines = s.select("loan_num", "perd_no", "part_id", F.when(F.col("perd_no") <= 3, F.col("supp_id")).alias("payee_id"))
    orders = t.read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    loan = orders.where(F.col("o_orderpriority") != "5-LOW").select(
        F.col("o_orderkey").alias("l_key"), F.col("o_custkey").alias("cust_id"), F.col("o_orderstatus").alias("loan_sts"))
    part = t.read("part", "p_partkey", "p_brand").select(F.col("p_partkey").alias("p_key"), F.col("p_brand").alias("part_brand"))
    payee = t.read("supplier", "s_suppkey", "s_name", "s_nationkey").select(
        F.col("s_suppkey").alias("s_key"), F.col("s_name").alias("payee_nam"), "s_nationkey")
    pair = (s.groupBy(F.col("part_id").alias("pair_part"), F.col("supp_id").alias("pair_supp"))
            .agg(F.count(F.lit(1)).alias("pair_lines"), money_sum("prcp_amt").alias("pair_prcp")))
    first = attach_many(lines, [
        Lookup(loan, ["l_key"], ["loan_num"]), Lookup(part, ["p_key"], ["part_id"]), Lookup(payee, ["s_key"], ["payee_id"]),
        Lookup(pair, ["pair_part", "pair_supp"], ["part_id", "payee_id"], unique=True)], row_key=["loan_num", "perd_no"], materialize=True)
    customer = t.read("customer", "c_custkey", "c_mktsegment").select(F.col("c_custkey").alias("c_key"), F.col("c_mktsegment").alias("cust_segment"))
    drawn = orders.groupBy(F.col("o_custkey").alias("d_key")).agg(F.count(F.lit(1)).alias("cust_loans"))
    nation = _nation(t, "n_nationkey", "n_name").select(F.col("n_nationkey").alias("n_key"), F.col("n_name").alias("payee_nation"))
    second = attach_many(first, [
        Lookup(customer, ["c_key"], ["cust_id"]), Lookup(drawn, ["d_key"], ["cust_id"], unique=True),
        Lookup(nation, ["n_key"], ["s_nationkey"])], row_key=["loan_num", "perd_no"], materialize=True)
    return second.select("loan_num", "perd_no", "cust_id", "loan_sts", "part_brand", "payee_nam", "pair_lines", "pair_prcp",
                         "cust_segment", "cust_loans", "payee_nation")


@query("split_left_join", with_sql(SCHED_SQL) + """,
asks AS (SELECT loan_num, perd_no, CASE WHEN perd_no <= 2 THEN NULL WHEN rtn_flag = 'N' THEN 1 ELSE supp_id END AS payee_id FROM sched)
SELECT a.loan_num, a.perd_no, a.payee_id, s.s_name AS payee_nam FROM asks a LEFT JOIN supplier s ON s.s_suppkey = a.payee_id""")
def split_left_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look-up where some third of the rows has no key and another third the same one."""
    t = tables(spark, sf_dir)
    payee = F.when(F.col("perd_no") > 2, F.when(F.col("rtn_flag") == "N", F.lit(1).cast("long")).otherwise(F.col("supp_id")))
    lines = schedule(t).select("loan_num", "perd_no", payee.alias("payee_id"))
    names = t.read("supplier", "s_suppkey", "s_name").select(F.col("s_suppkey").alias("s_key"), F.col("s_name").alias("payee_nam"))
    return split_left_join(lines, names, {"payee_id": "s_key"}).whole().select("loan_num", "perd_no", "payee_id", "payee_nam")
