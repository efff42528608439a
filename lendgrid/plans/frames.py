"""Driver tables renamed into the loan domain, plus the matching SQL CTEs.

Keeping the Spark frame and its SQL twin side by side makes each oracle a
direct restatement of the query rather than a second design.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendgrid.functions import money
from lendgrid.rundate import RunDate
from lendgrid.sources import Tables, history_from_events

# Fixed run dates of the demo queries: order/lineitem keys use mid-1998 (the
# data spans 1995-2001); event keys use mid-January 2024 (events cover
# January 2024 only).
RUN = RunDate(dt.date(1998, 6, 30))
EV_RUN = RunDate(dt.date(2024, 1, 15))



_CATALOGUES: dict[tuple[int, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """One table catalogue per (session, dataset root)."""
    key = (id(spark._jsparkSession), sf_dir)
    cat = _CATALOGUES.get(key)
    if cat is None or cat.spark is not spark:
        cat = _CATALOGUES[key] = Tables(spark, sf_dir)
    return cat


def loans(t: Tables, run: RunDate = RUN) -> DataFrame:
    """Loans drawn on or before D. The predicate is on the raw timestamp
    column so it reaches the Parquet scan as a pushed filter."""
    nxt = F.lit(run.d + dt.timedelta(days=1)).cast("timestamp_ntz")  # a date literal: no time zone involved
    o = t.read("orders").where(F.col("o_orderdate") < nxt)
    return o.select(
        F.col("o_orderkey").alias("loan_num"),
        F.col("o_custkey").alias("cust_id"),
        F.to_date("o_orderdate").alias("drawdown_dt"),
        money("o_totalprice").alias("loan_amt"),
        F.col("o_orderstatus").alias("loan_sts"),
        F.col("o_orderpriority").alias("priority"),
    )


LOANS_SQL = """loans AS (
  SELECT o_orderkey AS loan_num, o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS drawdown_dt,
         CAST(o_totalprice AS DECIMAL(18,2)) AS loan_amt, o_orderstatus AS loan_sts,
         o_orderpriority AS priority
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01')"""


def schedule(t: Tables) -> DataFrame:
    """Repayment schedule: one row per (loan, period) line. Interest is the
    line amount times its tax rate, in exact decimals."""
    li = t.read("lineitem")
    return li.select(
        F.col("l_orderkey").alias("loan_num"),
        F.col("l_linenumber").alias("perd_no"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supp_id"),
        F.to_date("l_shipdate").alias("due_dt"),
        money("l_extendedprice").alias("prcp_amt"),
        F.round(money("l_extendedprice") * money("l_tax"), 2).cast("decimal(18,2)").alias("int_amt"),
        money("l_discount").alias("disc_rate"),
        F.col("l_returnflag").alias("rtn_flag"),
        F.col("l_linestatus").alias("line_sts"),
        F.col("l_shipdate").alias("due_ts"),
    )


SCHED_SQL = """sched AS (
  SELECT l_orderkey AS loan_num, l_linenumber AS perd_no, l_partkey AS part_id, l_suppkey AS supp_id,
         CAST(l_shipdate AS DATE) AS due_dt,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS prcp_amt,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS int_amt,
         CAST(l_discount AS DECIMAL(18,2)) AS disc_rate,
         l_returnflag AS rtn_flag, l_linestatus AS line_sts
  FROM lineitem)"""


def hist(t: Tables) -> DataFrame:
    """Half-open account-state history per user derived from ``events``."""
    ev = t.read("events", "event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("value", money("value"))
    return history_from_events(ev, key="user_id", ts="ts", order_tiebreak="event_id",
                               payload=["event_type", "value"])


HIST_SQL = """hist AS (
  SELECT user_id, ts, event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value,
         CAST(ts AS DATE) AS begndt,
         COALESCE(CAST(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DATE), DATE '9999-12-31') AS overdt,
         strftime(CAST(ts AS DATE), '%Y%m') AS partid
  FROM events)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)
