"""Loan, schedule and history queries: as-of reads, latest-per-key, period
counts, overdue measures and pre-aggregated joins."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendgrid.functions import money_sum, overdue_days as overdue_days_expr
from lendgrid.operators import agg_join, collect_concat, first_flag, latest_by, lookup_unique, ordered_concat, top1_by_max
from lendgrid.plans.frames import (
    EV_RUN, HIST_SQL, LOANS_SQL, RUN, SCHED_SQL, hist, loans, schedule, tables, with_sql,
)
from lendgrid.plans.registry import query
from lendgrid.rundate import RunDate
from lendgrid.session import ensure_checkpoint_dir
from lendgrid.sources import PublishedSlices, as_of, as_of_dates, date_window, event_window, partition_only

D = RUN.d
D_SQL = "DATE '1998-06-30'"
SCHED_ORDER_ASC = ["due_dt", "perd_no", "part_id", "supp_id", "prcp_amt", "int_amt"]


def _asc(cols):
    return [F.col(c).asc_nulls_last() for c in cols]


def _desc(cols):
    return [F.col(c).desc_nulls_last() for c in cols]


def _due_by(run: RunDate = RUN):
    return F.col("due_dt") <= F.lit(run.d)


# ---------------------------------------------------------------- history reads

@query("asof_snapshot", with_sql(HIST_SQL) + """
SELECT user_id, event_id, event_type, value, begndt, overdt FROM hist
WHERE begndt <= DATE '2024-01-15' AND overdt > DATE '2024-01-15' AND partid = '202401'""")
def asof_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hist(tables(spark, sf_dir))
    return as_of(h, EV_RUN).select("user_id", "event_id", "event_type", "value", "begndt", "overdt")


def _stored(df: DataFrame, name: str, *partition_cols: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back."""
    path = ensure_checkpoint_dir(df.sparkSession).rstrip("/") + f"/lendgrid-{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_cols).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("asof_stored", with_sql(HIST_SQL) + """
SELECT user_id, event_id, event_type, value, begndt, overdt FROM hist
WHERE begndt <= DATE '2024-01-15' AND overdt > DATE '2024-01-15' AND partid = '202401'""")
def asof_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of read of a history table as it is stored, partitioned by month: of the
    folders one is read, and the validity bounds reach its scan."""
    stored = _stored(hist(tables(spark, sf_dir)), "history", "partid")
    return as_of(stored, EV_RUN).select("user_id", "event_id", "event_type", "value", "begndt", "overdt")


@query("asof_dates", with_sql(HIST_SQL) + """,
days AS (SELECT CAST(d AS DATE) AS as_of_dt FROM generate_series(DATE '2024-01-01', DATE '2024-02-02', INTERVAL 1 DAY) AS g(d))
SELECT as_of_dt, event_type, COUNT(*) AS n_rows, SUM(value) AS total
FROM hist JOIN days ON begndt <= as_of_dt AND overdt > as_of_dt GROUP BY as_of_dt, event_type""")
def asof_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state on 33 days of two months, from one scan of the history."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(33)]
    rows = as_of_dates(hist(tables(spark, sf_dir)), days, part=None)
    return rows.groupBy("as_of_dt", "event_type").agg(F.count(F.lit(1)).alias("n_rows"), money_sum("value").alias("total"))


@query("text_date_window", with_sql(SCHED_SQL) + """
SELECT loan_num, COUNT(*) AS n_lines, SUM(prcp_amt) AS total_prcp FROM sched
WHERE due_dt BETWEEN DATE '1998-06-01' AND DATE '1998-06-30' AND perd_no <> 7 GROUP BY loan_num""")
def text_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window over a stored text column of mixed layouts (compact, dashed, slashed, with a time
    behind it, with a space before it, no date at all)."""
    due = F.col("due_dt")
    text = (F.when(F.col("perd_no") == 1, F.date_format(due, "yyyyMMdd")).when(F.col("perd_no") == 2, F.date_format(due, "yyyy/MM/dd"))
            .when(F.col("perd_no") == 3, F.concat(due.cast("string"), F.lit(" 23:59:59"))).when(F.col("perd_no") == 4, F.concat(F.lit(" "), due.cast("string")))
            .when(F.col("perd_no") == 7, F.lit("null")).otherwise(due.cast("string")))
    lines = _stored(schedule(tables(spark, sf_dir)).select("loan_num", "prcp_amt", text.alias("due_text")), "text-dates")
    inside = date_window(lines, "due_text", RUN.month_start, RUN.d)
    return inside.groupBy("loan_num").agg(F.count(F.lit(1)).alias("n_lines"), money_sum("prcp_amt").alias("total_prcp"))


@query("latest_by_partition", with_sql(HIST_SQL) + """
SELECT user_id, event_id, event_type, begndt FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY begndt DESC, ts DESC, event_id DESC) AS rn
  FROM hist WHERE partid = '202401') WHERE rn = 1""")
def latest_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = partition_only(hist(tables(spark, sf_dir)), EV_RUN)
    return latest_by(h, ["user_id"], _desc(["begndt", "ts", "event_id"])).select(
        "user_id", "event_id", "event_type", "begndt")


# ------------------------------------------------------------- latest / first

@query("latest_per_key", with_sql(LOANS_SQL) + """
SELECT cust_id, loan_num, drawdown_dt, loan_amt FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY drawdown_dt DESC, loan_num DESC) AS rn
  FROM loans) WHERE rn = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = loans(tables(spark, sf_dir))
    return latest_by(lo, ["cust_id"], _desc(["drawdown_dt", "loan_num"])).select(
        "cust_id", "loan_num", "drawdown_dt", "loan_amt")


@query("latest_per_key_join", with_sql(LOANS_SQL) + """,
latest AS (SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY drawdown_dt DESC, loan_num DESC) AS rn
  FROM loans) WHERE rn = 1)
SELECT c.c_custkey AS cust_id, c.c_name AS cust_nam, c.c_mktsegment AS segment,
       l.loan_num AS latest_loan_num, l.drawdown_dt AS latest_drawdown_dt, l.loan_amt AS latest_loan_amt
FROM customer c LEFT JOIN latest l ON l.cust_id = c.c_custkey""")
def latest_per_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    latest = latest_by(loans(t), ["cust_id"], _desc(["drawdown_dt", "loan_num"]))
    c = t.read("customer", "c_custkey", "c_name", "c_mktsegment")
    j = c.join(latest, c.c_custkey == latest.cust_id, "left")
    return j.select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_nam"),
        F.col("c_mktsegment").alias("segment"), F.col("loan_num").alias("latest_loan_num"),
        F.col("drawdown_dt").alias("latest_drawdown_dt"), F.col("loan_amt").alias("latest_loan_amt"))


@query("first_account", with_sql(LOANS_SQL) + """,
ranked AS (SELECT cust_id, loan_num, drawdown_dt,
  ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY drawdown_dt, loan_num) AS rn FROM loans)
SELECT c.c_custkey AS cust_id, c.c_name AS cust_nam, r.loan_num AS first_loan_num,
       r.drawdown_dt AS first_drawdown_dt
FROM customer c LEFT JOIN ranked r ON r.cust_id = c.c_custkey AND r.rn = 1""")
def first_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    ranked = latest_by(loans(t), ["cust_id"], _asc(["drawdown_dt", "loan_num"]), rank_col="rn")
    c = t.read("customer", "c_custkey", "c_name")
    j = c.join(ranked, (ranked.cust_id == c.c_custkey) & (ranked.rn == 1), "left")
    return j.select(F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_nam"),
                    F.col("loan_num").alias("first_loan_num"), F.col("drawdown_dt").alias("first_drawdown_dt"))


@query("first_loan_flag", with_sql(LOANS_SQL) + """
SELECT loan_num, cust_id, drawdown_dt,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY drawdown_dt, loan_num) = 1
            THEN 'Y' ELSE 'N' END AS is_first_loan
FROM loans""")
def first_loan_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = loans(tables(spark, sf_dir)).select("loan_num", "cust_id", "drawdown_dt")
    return first_flag(lo, ["cust_id"], ["drawdown_dt", "loan_num"], ["loan_num"], "is_first_loan").select(
        "loan_num", "cust_id", "drawdown_dt", "is_first_loan")


@query("next_schedule", with_sql(SCHED_SQL) + """
SELECT loan_num, perd_no AS next_perd_no, due_dt AS next_due_dt, int_amt AS next_int_amt FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY loan_num
            ORDER BY due_dt, perd_no, part_id, supp_id, prcp_amt, int_amt) AS rn
  FROM sched WHERE due_dt > DATE '1998-06-30') WHERE rn = 1""")
def next_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    # due_dt > D, stated on the raw timestamp too so the scan can skip row groups
    after = F.lit(D + dt.timedelta(days=1)).cast("timestamp_ntz")
    s = schedule(tables(spark, sf_dir)).where((F.col("due_dt") > F.lit(D)) & (F.col("due_ts") >= after))
    return latest_by(s, ["loan_num"], _asc(SCHED_ORDER_ASC)).select(
        "loan_num", F.col("perd_no").alias("next_perd_no"), F.col("due_dt").alias("next_due_dt"),
        F.col("int_amt").alias("next_int_amt"))


@query("top1_three_ways", with_sql(SCHED_SQL) + """,
w AS (SELECT loan_num, perd_no AS last_perd_w FROM (
  SELECT loan_num, perd_no, ROW_NUMBER() OVER (PARTITION BY loan_num ORDER BY perd_no DESC) AS rn FROM sched)
  WHERE rn = 1),
g AS (SELECT loan_num, MAX(perd_no) AS last_perd_g FROM sched GROUP BY loan_num),
c AS (SELECT s.loan_num, COUNT(*) AS n_last_lines, SUM(s.prcp_amt) AS last_prcp_sum FROM sched s
      WHERE s.perd_no = (SELECT MAX(x.perd_no) FROM sched x WHERE x.loan_num = s.loan_num)
      GROUP BY s.loan_num)
SELECT w.loan_num, w.last_perd_w, g.last_perd_g, c.n_last_lines, c.last_prcp_sum
FROM w JOIN g ON g.loan_num = w.loan_num JOIN c ON c.loan_num = w.loan_num""")
def top1_three_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = schedule(tables(spark, sf_dir)).select("loan_num", "perd_no", "prcp_amt")
    w = latest_by(s, ["loan_num"], _desc(["perd_no"])).select("loan_num", F.col("perd_no").alias("last_perd_w"))
    g = s.groupBy("loan_num").agg(F.max("perd_no").alias("last_perd_g"))
    c = top1_by_max(s, ["loan_num"], "perd_no").groupBy("loan_num").agg(
        F.count(F.lit(1)).alias("n_last_lines"), money_sum("prcp_amt").alias("last_prcp_sum"))
    return w.join(g, "loan_num").join(c, "loan_num")


# ------------------------------------------------------ schedule-derived measures

def _loan_line_aggs(spark: SparkSession, sf_dir: str, *aggs) -> DataFrame:
    """All loans drawn by D with per-loan schedule aggregates (left join of a
    pre-aggregate keyed on the loan number: both sides unique per key)."""
    t = tables(spark, sf_dir)
    return agg_join(loans(t), schedule(t), ["loan_num"], list(aggs))


def _unpaid():
    """Principal unpaid: a line not returned, due on or before D."""
    return (F.col("rtn_flag") == "N") & _due_by()


def _open_due():
    """Interest unpaid: an open line due on or before D."""
    return (F.col("line_sts") == "O") & _due_by()


@query("earliest_unpaid", with_sql(LOANS_SQL, SCHED_SQL) + """,
e AS (SELECT loan_num, MIN(due_dt) AS earliest_unpaid_dt FROM sched
      WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30' GROUP BY loan_num)
SELECT l.loan_num, e.earliest_unpaid_dt, COALESCE(e.earliest_unpaid_dt, DATE '9999-12-31') AS earliest_or_open
FROM loans l LEFT JOIN e ON e.loan_num = l.loan_num""")
def earliest_unpaid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    e = schedule(t).where(_unpaid()).groupBy("loan_num").agg(F.min("due_dt").alias("earliest_unpaid_dt"))
    return loans(t).join(e, "loan_num", "left").select(
        "loan_num", "earliest_unpaid_dt",
        F.coalesce("earliest_unpaid_dt", F.lit(dt.date(9999, 12, 31))).alias("earliest_or_open"))


@query("current_period", with_sql(SCHED_SQL) + """
SELECT loan_num, COALESCE(MIN(perd_no) FILTER (WHERE due_dt > DATE '1998-06-30'), MAX(perd_no)) AS curr_perd
FROM sched GROUP BY loan_num""")
def current_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = schedule(tables(spark, sf_dir))
    return s.groupBy("loan_num").agg(
        F.coalesce(F.min(F.when(F.col("due_dt") > F.lit(D), F.col("perd_no"))), F.max("perd_no")).alias("curr_perd"))


_CONSEC_SQL = """,
fu AS (SELECT loan_num, MIN(due_dt) AS first_unpaid FROM sched
       WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30' GROUP BY loan_num),
cs AS (SELECT s.loan_num, COUNT(*) AS consec_perds FROM sched s JOIN fu ON fu.loan_num = s.loan_num
       WHERE s.due_dt >= fu.first_unpaid AND s.due_dt <= DATE '1998-06-30' GROUP BY s.loan_num)"""


def _consecutive(s: DataFrame) -> DataFrame:
    fu = s.where(_unpaid()).groupBy("loan_num").agg(F.min("due_dt").alias("first_unpaid"))
    return (s.join(fu, "loan_num").where((F.col("due_dt") >= F.col("first_unpaid")) & _due_by())
            .groupBy("loan_num").agg(F.count(F.lit(1)).alias("consec_perds")))


@query("consecutive_periods", with_sql(LOANS_SQL, SCHED_SQL) + _CONSEC_SQL + """
SELECT l.loan_num, COALESCE(cs.consec_perds, 0) AS consec_perds FROM loans l LEFT JOIN cs ON cs.loan_num = l.loan_num""")
def consecutive_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    cs = _consecutive(schedule(t))
    return loans(t).join(cs, "loan_num", "left").select(
        "loan_num", F.coalesce("consec_perds", F.lit(0).cast("bigint")).alias("consec_perds"))


@query("cumulative_periods", with_sql(LOANS_SQL, SCHED_SQL) + _CONSEC_SQL + """,
cu AS (SELECT loan_num, COUNT(*) AS cum_perds FROM sched
       WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30' GROUP BY loan_num)
SELECT l.loan_num, COALESCE(cu.cum_perds, 0) AS cum_perds,
       GREATEST(COALESCE(cu.cum_perds, 0), COALESCE(cs.consec_perds, 0)) AS od_perds
FROM loans l LEFT JOIN cu ON cu.loan_num = l.loan_num LEFT JOIN cs ON cs.loan_num = l.loan_num""")
def cumulative_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    s = schedule(t)
    cu = s.where(_unpaid()).groupBy("loan_num").agg(F.count(F.lit(1)).alias("cum_perds"))
    j = loans(t).join(cu, "loan_num", "left").join(_consecutive(s), "loan_num", "left")
    zero = F.lit(0).cast("bigint")
    return j.select("loan_num", F.coalesce("cum_perds", zero).alias("cum_perds"),
                    F.greatest(F.coalesce("cum_perds", zero), F.coalesce("consec_perds", zero)).alias("od_perds"))


@query("overdue_count", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT l.loan_num, COALESCE(n.od_cnt, 0) AS od_cnt FROM loans l LEFT JOIN (
  SELECT loan_num, COUNT(*) AS od_cnt FROM sched WHERE line_sts = 'O' AND due_dt <= DATE '1998-06-30'
  GROUP BY loan_num) n ON n.loan_num = l.loan_num""")
def overdue_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    n = schedule(t).where(_open_due()).groupBy("loan_num").agg(F.count(F.lit(1)).alias("od_cnt"))
    return loans(t).join(n, "loan_num", "left").select(
        "loan_num", F.coalesce("od_cnt", F.lit(0).cast("bigint")).alias("od_cnt"))


@query("overdue_principal", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT l.loan_num, SUM(s.prcp_amt) AS od_prcp_amt
FROM loans l LEFT JOIN sched s ON s.loan_num = l.loan_num
WHERE s.rtn_flag = 'N' AND s.due_dt <= DATE '1998-06-30'
GROUP BY l.loan_num""")
def overdue_principal(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The filter is on the null side of the left join, so Catalyst turns the
    # join into an inner join (EliminateOuterJoin) and pushes it to the scan.
    t = tables(spark, sf_dir)
    j = loans(t).join(schedule(t), "loan_num", "left").where(_unpaid())
    return j.groupBy("loan_num").agg(money_sum("prcp_amt").alias("od_prcp_amt"))


_OD_AMOUNTS_SQL = """,
a AS (SELECT loan_num,
        SUM(prcp_amt) FILTER (WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30') AS od_prcp_amt,
        SUM(int_amt) FILTER (WHERE line_sts = 'O' AND due_dt <= DATE '1998-06-30') AS od_int_amt,
        SUM(ROUND(prcp_amt * disc_rate, 2)) FILTER (WHERE rtn_flag = 'R') AS waived_amt
      FROM sched GROUP BY loan_num)"""


@query("overdue_amounts", with_sql(LOANS_SQL, SCHED_SQL) + _OD_AMOUNTS_SQL + """
SELECT l.loan_num, a.od_prcp_amt, a.od_int_amt, a.waived_amt,
       COALESCE(a.od_prcp_amt, 0) + COALESCE(a.od_int_amt, 0) - COALESCE(a.waived_amt, 0) AS net_od_amt
FROM loans l LEFT JOIN a ON a.loan_num = l.loan_num""")
def overdue_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _loan_line_aggs(
        spark, sf_dir,
        money_sum(F.when(_unpaid(), F.col("prcp_amt"))).alias("od_prcp_amt"),
        money_sum(F.when(_open_due(), F.col("int_amt"))).alias("od_int_amt"),
        money_sum(F.when(F.col("rtn_flag") == "R", F.round(F.col("prcp_amt") * F.col("disc_rate"), 2))).alias("waived_amt"),
    )
    z = F.lit(0)
    net = F.coalesce("od_prcp_amt", z) + F.coalesce("od_int_amt", z) - F.coalesce("waived_amt", z)
    return j.select("loan_num", "od_prcp_amt", "od_int_amt", "waived_amt", net.alias("net_od_amt"))


_OD_DAYS_SQL = """,
od AS (SELECT loan_num,
         MIN(due_dt) FILTER (WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30') AS p_od_dt,
         MIN(due_dt) FILTER (WHERE line_sts = 'O' AND due_dt <= DATE '1998-06-30') AS i_od_dt
       FROM sched GROUP BY loan_num),
odd AS (SELECT l.loan_num, od.p_od_dt, od.i_od_dt,
          GREATEST(CASE WHEN od.p_od_dt IS NOT NULL THEN date_diff('day', od.p_od_dt, DATE '1998-06-30') + 1 ELSE 0 END,
                   CASE WHEN od.i_od_dt IS NOT NULL THEN date_diff('day', od.i_od_dt, DATE '1998-06-30') + 1 ELSE 0 END) AS od_days
        FROM loans l LEFT JOIN od ON od.loan_num = l.loan_num)"""


def overdue_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per loan: earliest unpaid principal / interest dates and days overdue."""
    j = _loan_line_aggs(
        spark, sf_dir,
        F.min(F.when(_unpaid(), F.col("due_dt"))).alias("p_od_dt"),
        F.min(F.when(_open_due(), F.col("due_dt"))).alias("i_od_dt"),
    )
    return j.withColumn("od_days", overdue_days_expr(D, "p_od_dt", "i_od_dt"))


@query("overdue_days", with_sql(LOANS_SQL, SCHED_SQL) + _OD_DAYS_SQL + """
SELECT loan_num, p_od_dt, i_od_dt, od_days, CASE WHEN od_days > 0 THEN 'Y' ELSE 'N' END AS od_flg FROM odd""")
def overdue_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = overdue_frame(spark, sf_dir)
    return j.select("loan_num", "p_od_dt", "i_od_dt", F.col("od_days").cast("bigint").alias("od_days"),
                    F.when(F.col("od_days") > 0, F.lit("Y")).otherwise(F.lit("N")).alias("od_flg"))


@query("arrears_floor", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT l.loan_num,
       CASE WHEN l.loan_sts IN ('O', 'P') THEN GREATEST(COALESCE(n.n, 0), 1) ELSE COALESCE(n.n, 0) END AS arrears_cnt
FROM loans l LEFT JOIN (
  SELECT loan_num, COUNT(*) AS n FROM sched
  WHERE rtn_flag = 'N' AND line_sts = 'O' AND due_dt <= DATE '1998-06-30' GROUP BY loan_num) n
ON n.loan_num = l.loan_num""")
def arrears_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _loan_line_aggs(spark, sf_dir, F.count(F.when(_unpaid() & (F.col("line_sts") == "O"), F.lit(1))).alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return j.select("loan_num", F.when(F.col("loan_sts").isin("O", "P"), F.greatest(n, F.lit(1).cast("bigint")))
                    .otherwise(n).alias("arrears_cnt"))


# ------------------------------------------------------- customer aggregates

@query("cond_sum", with_sql(LOANS_SQL, SCHED_SQL) + """,
sf AS (SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 'Y' ELSE 'N' END AS s_flag FROM supplier)
SELECT l.cust_id, SUM(s.prcp_amt) AS sum_all,
  SUM(CASE WHEN p.p_type IN ('SMALL', 'MEDIUM') OR (p.p_type IN ('PROMO', 'LARGE') AND
        (SELECT sf.s_flag FROM sf WHERE sf.s_suppkey = s.supp_id) = 'Y') THEN s.prcp_amt ELSE 0 END) AS sum_opr,
  SUM(CASE WHEN p.p_type IN ('ECONOMY', 'STANDARD') OR (p.p_type IN ('PROMO', 'LARGE') AND
        COALESCE((SELECT sf.s_flag FROM sf WHERE sf.s_suppkey = s.supp_id), 'N') <> 'Y') THEN s.prcp_amt ELSE 0 END) AS sum_con
FROM loans l JOIN sched s ON s.loan_num = l.loan_num LEFT JOIN part p ON p.p_partkey = s.part_id
WHERE l.loan_sts = 'O' AND s.prcp_amt > 0
GROUP BY l.cust_id""")
def cond_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    lines = loans(t).where(F.col("loan_sts") == "O").join(
        schedule(t).where(F.col("prcp_amt") > 0), "loan_num")
    p = t.read("part", "p_partkey", "p_type")
    lines = lines.join(p, lines.part_id == p.p_partkey, "left")
    sup = t.read("supplier", "s_suppkey", "s_acctbal").select(
        F.col("s_suppkey").alias("supp_id"),
        F.when(F.col("s_acctbal") > 0, F.lit("Y")).otherwise(F.lit("N")).alias("s_flag"))
    lines = lookup_unique(lines, sup, ["supp_id"], ["s_flag"], name="supplier flag")
    two = F.col("p_type").isin("PROMO", "LARGE")
    opr = F.col("p_type").isin("SMALL", "MEDIUM") | (two & (F.col("s_flag") == "Y"))
    con = F.col("p_type").isin("ECONOMY", "STANDARD") | (two & (F.coalesce("s_flag", F.lit("N")) != "Y"))
    zero = F.lit(0).cast("decimal(18,2)")
    return lines.groupBy("cust_id").agg(
        money_sum("prcp_amt").alias("sum_all"),
        money_sum(F.when(opr, F.col("prcp_amt")).otherwise(zero)).alias("sum_opr"),
        money_sum(F.when(con, F.col("prcp_amt")).otherwise(zero)).alias("sum_con"))


@query("ytd_sum", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT l.cust_id, SUM(COALESCE(s.int_amt, 0)) AS ytd_int, COUNT(*) AS ytd_lines
FROM loans l JOIN sched s ON s.loan_num = l.loan_num
WHERE s.due_dt BETWEEN date_trunc('year', DATE '1998-06-30') AND last_day(DATE '1998-06-30')
GROUP BY l.cust_id""")
def ytd_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    s = event_window(schedule(t), "due_dt", RUN.year_start, RUN.month_end, raw_ts="due_ts")
    return loans(t).join(s, "loan_num").groupBy("cust_id").agg(
        money_sum(F.coalesce("int_amt", F.lit(0))).alias("ytd_int"), F.count(F.lit(1)).alias("ytd_lines"))


@query("mtd_latest", with_sql(SCHED_SQL) + """
SELECT loan_num, perd_no, due_dt, prcp_amt, int_amt FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY loan_num
     ORDER BY due_dt DESC, perd_no DESC, part_id DESC, supp_id DESC, prcp_amt DESC, int_amt DESC) AS rn
  FROM sched WHERE due_dt BETWEEN DATE '1998-06-01' AND DATE '1998-06-30') WHERE rn = 1""")
def mtd_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = event_window(schedule(tables(spark, sf_dir)), "due_dt", RUN.month_start, RUN.d, raw_ts="due_ts")
    return latest_by(s, ["loan_num"], _desc(SCHED_ORDER_ASC)).select(
        "loan_num", "perd_no", "due_dt", "prcp_amt", "int_amt")


@query("agg_then_join", with_sql(LOANS_SQL, SCHED_SQL) + """
SELECT l.loan_num, l.loan_amt, a.total_prcp, COALESCE(a.n_lines, 0) AS n_lines
FROM loans l LEFT JOIN (SELECT loan_num, SUM(prcp_amt) AS total_prcp, COUNT(*) AS n_lines
                        FROM sched GROUP BY loan_num) a ON a.loan_num = l.loan_num""")
def agg_then_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _loan_line_aggs(spark, sf_dir, money_sum("prcp_amt").alias("total_prcp"),
                        F.count(F.lit(1)).alias("n_lines"))
    return j.select("loan_num", "loan_amt", "total_prcp",
                    F.coalesce("n_lines", F.lit(0).cast("bigint")).alias("n_lines"))


def loan_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intermediate loan detail (one row per loan) read back by the ledger."""
    return _loan_line_aggs(
        spark, sf_dir,
        F.max("due_dt").alias("last_due_dt"),
        F.sum(F.when(_unpaid(), F.col("prcp_amt"))).alias("od_prcp_amt"),
        F.sum(F.when(_open_due(), F.col("int_amt"))).alias("od_int_amt"),
    )


@query("detail_feedback", with_sql(LOANS_SQL, SCHED_SQL) + """,
detail AS (SELECT l.loan_num, MAX(s.due_dt) AS last_due_dt,
             SUM(s.prcp_amt) FILTER (WHERE s.rtn_flag = 'N' AND s.due_dt <= DATE '1998-06-30') AS od_prcp_amt,
             SUM(s.int_amt) FILTER (WHERE s.line_sts = 'O' AND s.due_dt <= DATE '1998-06-30') AS od_int_amt
           FROM loans l LEFT JOIN sched s ON s.loan_num = l.loan_num GROUP BY l.loan_num)
SELECT loan_num, last_due_dt,
  CASE WHEN od_prcp_amt > 0 AND od_int_amt > 0 THEN '03' WHEN od_prcp_amt > 0 THEN '01'
       WHEN od_int_amt > 0 THEN '02' END AS od_type,
  CASE WHEN last_due_dt < DATE '1998-06-30' THEN '2' ELSE '1' END AS loan_state
FROM detail""")
def detail_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail as it was written: published as the slice of its date, then read back."""
    rows = loan_detail(spark, sf_dir).withColumn("rpt_dt", F.lit(D))
    store = PublishedSlices(spark, ensure_checkpoint_dir(spark).rstrip("/") + f"/lendgrid-detail-{uuid.uuid4().hex}", rows.schema, ["rpt_dt"])
    version = store.stage(rows)
    store.publish(store.staged_counts(version), version)
    d = store.read(rpt_dt=D.isoformat())
    p, i = F.col("od_prcp_amt"), F.col("od_int_amt")
    od_type = F.when((p > 0) & (i > 0), "03").when(p > 0, "01").when(i > 0, "02")
    state = F.when(F.col("last_due_dt") < F.lit(D), "2").otherwise("1")
    return d.select("loan_num", "last_due_dt", od_type.alias("od_type"), state.alias("loan_state"))


@query("guarantee_class", with_sql(LOANS_SQL, SCHED_SQL) + """,
gc AS (SELECT l.loan_num, MAX(l.priority) AS bc_vouch, MAX(p.p_brand) AS vouch,
         COUNT(DISTINCT substr(p.p_type, 1, 3)) AS dblxs,
         COUNT(CASE WHEN p.p_brand LIKE 'Brand#2%' THEN s.part_id END) AS fdcdys,
         COUNT(CASE WHEN p.p_brand NOT LIKE 'Brand#3%' THEN s.part_id END) AS qtdbs
       FROM loans l
       LEFT JOIN sched s ON s.loan_num = l.loan_num AND s.rtn_flag IN ('A', 'N')
       LEFT JOIN part p ON p.p_partkey = s.part_id
       GROUP BY l.loan_num)
SELECT loan_num, dblxs, TRIM(CASE
  WHEN dblxs = 1 THEN CASE
    WHEN vouch LIKE 'Brand#1%' THEN 'A'
    WHEN vouch LIKE 'Brand#4%' OR vouch = 'Brand#5' THEN 'C99'
    WHEN fdcdys > 0 AND bc_vouch LIKE '1-%' THEN 'B01'
    WHEN fdcdys > 0 AND qtdbs > 0 THEN 'E01'
    WHEN vouch LIKE 'Brand#2%' THEN 'B99' END
  WHEN dblxs = 0 THEN 'D'
  WHEN dblxs > 1 THEN CASE
    WHEN fdcdys > 0 AND bc_vouch LIKE '1-%' THEN 'B01'
    WHEN fdcdys > 0 AND qtdbs > 0 THEN 'E01'
    ELSE 'E' END
  END) AS guaranty_typ
FROM gc""")
def guarantee_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    lines = schedule(t).where(F.col("rtn_flag").isin("A", "N")).select("loan_num", "part_id")
    p = t.read("part", "p_partkey", "p_brand", "p_type")
    j = loans(t).join(lines, "loan_num", "left").join(p, F.col("part_id") == p.p_partkey, "left")
    gc = j.groupBy("loan_num").agg(
        F.max("priority").alias("bc_vouch"), F.max("p_brand").alias("vouch"),
        F.count_distinct(F.substring("p_type", 1, 3)).alias("dblxs"),
        F.count(F.when(F.col("p_brand").like("Brand#2%"), F.col("part_id"))).alias("fdcdys"),
        F.count(F.when(~F.col("p_brand").like("Brand#3%"), F.col("part_id"))).alias("qtdbs"))
    v, bv = F.col("vouch"), F.col("bc_vouch")
    fd, qt = F.col("fdcdys"), F.col("qtdbs")
    one = (F.when(v.like("Brand#1%"), "A")
           .when(v.like("Brand#4%") | (v == "Brand#5"), "C99")
           .when((fd > 0) & bv.like("1-%"), "B01")
           .when((fd > 0) & (qt > 0), "E01")
           .when(v.like("Brand#2%"), "B99"))
    many = F.when((fd > 0) & bv.like("1-%"), "B01").when((fd > 0) & (qt > 0), "E01").otherwise("E")
    n = F.col("dblxs")
    cls = F.when(n == 1, one).when(n == 0, "D").when(n > 1, many)
    return gc.select("loan_num", "dblxs", F.trim(cls).alias("guaranty_typ"))


@query("global_min_flag", with_sql(LOANS_SQL) + """
SELECT loan_num, CASE WHEN loan_num = (SELECT MIN(loan_num) FROM loans) THEN 'Y' ELSE 'N' END AS is_min_loan
FROM loans""")
def global_min_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    # An uncorrelated scalar subquery: Spark runs the one-row aggregate once
    # and inlines the value; no join, no driver-side collect.
    lo = loans(tables(spark, sf_dir))
    first = lo.agg(F.min("loan_num")).scalar()
    return lo.select("loan_num", F.when(F.col("loan_num") == first, "Y").otherwise("N").alias("is_min_loan"))


@query("threshold_flag", with_sql(LOANS_SQL) + """,
bal AS (SELECT l.cust_id, SUM(COALESCE(l.loan_amt, 0)) AS balancesum
        FROM loans l JOIN customer c ON c.c_custkey = l.cust_id
        WHERE l.loan_sts = 'O' AND COALESCE(c.c_mktsegment, 'HOUSEHOLD') IN ('HOUSEHOLD', 'BUILDING')
        GROUP BY l.cust_id)
SELECT l.loan_num, b.balancesum,
  CASE WHEN (c.c_mktsegment = 'AUTOMOBILE' AND b.balancesum <= 5000000)
         OR (COALESCE(c.c_mktsegment, 'HOUSEHOLD') IN ('HOUSEHOLD', 'BUILDING') AND l.loan_sts = 'O'
             AND b.balancesum <= 10000000) THEN 'Y' ELSE 'N' END AS generalize_loan_flg
FROM loans l LEFT JOIN customer c ON c.c_custkey = l.cust_id LEFT JOIN bal b ON b.cust_id = l.cust_id""")
def threshold_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    lo = loans(t)
    c = t.read("customer", "c_custkey", "c_mktsegment")
    scope = F.coalesce(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).isin("HOUSEHOLD", "BUILDING")
    bal = (lo.where(F.col("loan_sts") == "O").join(c, lo.cust_id == c.c_custkey).where(scope)
           .groupBy("cust_id").agg(money_sum(F.coalesce("loan_amt", F.lit(0))).alias("balancesum")))
    j = lo.join(c, lo.cust_id == c.c_custkey, "left").join(bal, "cust_id", "left")
    b = F.col("balancesum")
    flag = F.when(((F.col("c_mktsegment") == "AUTOMOBILE") & (b <= 5000000)) |
                  (scope & (F.col("loan_sts") == "O") & (b <= 10000000)), "Y").otherwise("N")
    return j.select("loan_num", "balancesum", flag.alias("generalize_loan_flg"))


@query("collect_concat", with_sql(LOANS_SQL) + """
SELECT cust_id, string_agg(v, '|' ORDER BY v) AS prior_loans FROM (
  SELECT cust_id, CASE WHEN substr(CAST(loan_num AS VARCHAR), 1, 1) = '1'
                       THEN substr(CAST(loan_num AS VARCHAR), 1, 14) || '1' ELSE CAST(loan_num AS VARCHAR) END AS v
  FROM loans) GROUP BY cust_id""")
def collect_concat_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = loans(tables(spark, sf_dir))
    v = F.col("loan_num").cast("string")
    rewritten = F.when(F.substring(v, 1, 1) == "1", F.concat(F.substring(v, 1, 14), F.lit("1"))).otherwise(v)
    return collect_concat(lo, ["cust_id"], rewritten, "|", "prior_loans")


@query("pivot_flags", with_sql(SCHED_SQL) + """
SELECT loan_num,
  COUNT(*) FILTER (WHERE rtn_flag = 'A') AS n_a,
  COUNT(*) FILTER (WHERE rtn_flag = 'R') AS n_r,
  COUNT(*) FILTER (WHERE rtn_flag = 'N') AS n_n,
  SUM(prcp_amt) FILTER (WHERE rtn_flag = 'R') AS prcp_r,
  SUM(int_amt) FILTER (WHERE line_sts = 'O') AS int_open,
  CASE WHEN MAX(CASE WHEN line_sts = 'O' THEN 1 ELSE 0 END) = 1 THEN 'Y' ELSE 'N' END AS has_open
FROM sched GROUP BY loan_num""")
def pivot_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One aggregate pass replaces a separately filtered join per target field.
    s = schedule(tables(spark, sf_dir))
    r = F.col("rtn_flag")
    return s.groupBy("loan_num").agg(
        F.count(F.when(r == "A", 1)).alias("n_a"),
        F.count(F.when(r == "R", 1)).alias("n_r"),
        F.count(F.when(r == "N", 1)).alias("n_n"),
        money_sum(F.when(r == "R", F.col("prcp_amt"))).alias("prcp_r"),
        money_sum(F.when(F.col("line_sts") == "O", F.col("int_amt"))).alias("int_open"),
        F.when(F.max(F.when(F.col("line_sts") == "O", 1).otherwise(0)) == 1, "Y").otherwise("N").alias("has_open"))


@query("ordered_concat", with_sql(SCHED_SQL) + """
SELECT rtn_flag, md5(string_agg(CAST(loan_num AS VARCHAR), '|' ORDER BY CAST(loan_num AS VARCHAR))) AS loans_md5, COUNT(*) AS n_loans
FROM sched GROUP BY rtn_flag""")
def ordered_concat_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans of all lines by return flag: three keys, each with a third of all rows."""
    s = schedule(tables(spark, sf_dir)).select("rtn_flag", F.col("loan_num").cast("string").alias("v"))
    lists = ordered_concat(s, ["rtn_flag"], "v", "|", "loans")
    return lists.select("rtn_flag", F.md5(F.col("loans").cast("binary")).alias("loans_md5"),
                        (F.length("loans") - F.length(F.replace("loans", F.lit("|"), F.lit(""))) + 1).cast("bigint").alias("n_loans"))
