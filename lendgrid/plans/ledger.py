"""Ledger-level queries: six tagged segments unioned into the canonical
ledger, the first-loan flag, per-segment row counts, the prior-period
self-lookup, the idempotent slice rewrite and the flagship loan overview.

The driver tables carry one loan system, so the six segments are carved out
of it by priority/status; each segment fills its own subset of ledger
columns with its own conventions (e.g. overdue days +1 in CL_1, plain in
PL_2), exactly as the six source systems do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendgrid.functions import decode, money_sum, overdue_days
from lendgrid.job import LedgerJob, read_ledger
from lendgrid.operators import agg_join, first_flag
from lendgrid.operators.ledger import LEDGER, conform, flag_first_loan, split_segments, union_segments  # noqa: F401
from lendgrid.plans.frames import RUN, SCHED_SQL, loans, schedule, tables, with_sql
from lendgrid.plans.registry import query
from lendgrid.rundate import RunDate
from lendgrid.session import ensure_checkpoint_dir
from lendgrid.sources import PublishedSlices, RunLog, Tables, read_slice, replace_slice, write_bucketed

OUT_COLS = ["loan_num", "date_sourcesd", "data_date", "cust_id", "drawdown_dt", "drawdown_amt", "maturity_dt",
            "od_days", "od_flg", "acct_sts", "p_od_dt", "i_od_dt", "year_int_incom", "od_loan_acct_bal",
            "draft_nbr", "is_first_loan_tag", "is_first_report_loan_tag"]

# Segment membership on the driver tables.
SEGMENT_PRIORITY = {"CL_1": "1-URGENT", "PL_2": "2-HIGH", "NL_3": "3-MEDIUM", "WBYXNL_4": "4-NOT SPECIFIED"}


def base_measures(t: Tables, run: RunDate) -> DataFrame:
    """Loans drawn by the run date with the schedule measures every segment
    uses, aggregated once per loan."""
    due = F.col("due_dt") <= F.lit(run.d)
    return agg_join(loans(t, run), schedule(t), ["loan_num"], [
        F.min(F.when((F.col("rtn_flag") == "N") & due, F.col("due_dt"))).alias("p_od_dt"),
        F.min(F.when((F.col("line_sts") == "O") & due, F.col("due_dt"))).alias("i_od_dt"),
        F.max("due_dt").alias("maturity_dt"),
        F.sum(F.when((F.col("rtn_flag") == "N") & due, F.col("prcp_amt"))).alias("od_prcp_amt"),
        F.sum(F.when(F.col("due_dt").between(F.lit(run.year_start), F.lit(run.d)), F.col("int_amt"))).alias("ytd_int"),
    ])


def segment_specs(run: RunDate) -> list[tuple[str, Column, dict[str, Column]]]:
    """The six segments: membership predicate and the ledger columns each
    fills, with its own conventions."""
    d = F.lit(run.d)
    pri, sts = F.col("priority"), F.col("loan_sts")
    common = {"loan_num": F.col("loan_num"), "cust_id": F.col("cust_id"),
              "drawdown_dt": F.col("drawdown_dt"), "drawdown_amt": F.col("loan_amt")}
    cl_days = overdue_days(run.d, "p_od_dt", "i_od_dt")
    low = pri == "5-LOW"
    return [
        ("CL_1", pri == SEGMENT_PRIORITY["CL_1"], {
            **common, "maturity_dt": F.col("maturity_dt"), "od_days": cl_days,
            "od_flg": F.when(cl_days > 0, "Y").otherwise("N"),
            "acct_sts": F.when(sts == "F", "03").otherwise("01")}),
        ("PL_2", pri == SEGMENT_PRIORITY["PL_2"], {
            **common, "p_od_dt": F.col("p_od_dt"), "i_od_dt": F.col("i_od_dt"),
            "od_days": F.datediff(d, F.col("p_od_dt")), "year_int_incom": F.col("ytd_int")}),
        ("NL_3", pri == SEGMENT_PRIORITY["NL_3"], {
            **common, "acct_sts": decode("loan_sts", {"F": "03", "O": "01", "P": "02"}),
            "od_loan_acct_bal": F.col("od_prcp_amt")}),
        ("WBYXNL_4", pri == SEGMENT_PRIORITY["WBYXNL_4"], {
            **common, "maturity_dt": F.col("maturity_dt"),
            "od_flg": F.when(F.col("p_od_dt").isNotNull(), "Y").otherwise("N")}),
        ("BS_5", low & (sts == "F"), {
            **common, "draft_nbr": F.concat(F.lit("B"), F.col("loan_num").cast("string")),
            "od_days": F.when(F.col("maturity_dt") < d, F.datediff(d, F.col("maturity_dt"))).otherwise(F.lit(0))}),
        ("XL_6", low & ~(sts == "F"), {
            **common, "is_first_loan_tag": F.when(F.col("loan_amt") > 100000, "1").otherwise("2"),
            "year_int_incom": F.col("ytd_int")}),
    ]


def segments(base: DataFrame, run: RunDate) -> dict[str, DataFrame]:
    """The segments as separate frames (one filtered projection each)."""
    return {tag: base.where(pred).select(*[c.alias(n) for n, c in cols.items()])
            for tag, pred, cols in segment_specs(run)}


def ledger_slice(t: Tables, run: RunDate) -> DataFrame:
    """The full 137-column ledger slice of one business date, first-loan
    flag included. The segments share one input here, so they are built in
    a single pass (``split_segments``); separate source systems go through
    ``union_segments``."""
    base = base_measures(t, run)
    # typed to the ledger (loan numbers are text there, which decides the
    # first-loan order) but not yet widened: the flag's join shuffles ~20
    # columns instead of 137
    narrow = conform(split_segments(base, segment_specs(run), run.d8, schema=None), fill_missing=False)
    return conform(flag_first_loan(narrow))


def _ledger_sql(d: str, name: str = "ledger") -> str:
    """SQL twin of ``ledger_slice`` for business date ``d`` (ISO)."""
    dd = f"DATE '{d}'"
    ys = f"DATE '{d[:4]}-01-01'"
    d8 = d.replace("-", "")
    b = f"{name}_base"
    return f"""{b} AS (
  SELECT l.loan_num, l.cust_id, l.drawdown_dt, l.loan_amt, l.loan_sts, l.priority,
    MIN(s.due_dt) FILTER (WHERE s.rtn_flag = 'N' AND s.due_dt <= {dd}) AS p_od_dt,
    MIN(s.due_dt) FILTER (WHERE s.line_sts = 'O' AND s.due_dt <= {dd}) AS i_od_dt,
    MAX(s.due_dt) AS maturity_dt,
    SUM(s.prcp_amt) FILTER (WHERE s.rtn_flag = 'N' AND s.due_dt <= {dd}) AS od_prcp_amt,
    SUM(s.int_amt) FILTER (WHERE s.due_dt BETWEEN {ys} AND {dd}) AS ytd_int
  FROM (SELECT o_orderkey AS loan_num, o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS drawdown_dt,
               CAST(o_totalprice AS DECIMAL(18,2)) AS loan_amt, o_orderstatus AS loan_sts, o_orderpriority AS priority
        FROM orders WHERE CAST(o_orderdate AS DATE) <= {dd}) l
  LEFT JOIN sched s ON s.loan_num = l.loan_num
  GROUP BY l.loan_num, l.cust_id, l.drawdown_dt, l.loan_amt, l.loan_sts, l.priority),
{name}_u AS (
  SELECT loan_num, 'CL_1' AS date_sourcesd, cust_id, drawdown_dt, loan_amt AS drawdown_amt, maturity_dt,
    GREATEST(CASE WHEN p_od_dt IS NOT NULL THEN date_diff('day', p_od_dt, {dd}) + 1 ELSE 0 END,
             CASE WHEN i_od_dt IS NOT NULL THEN date_diff('day', i_od_dt, {dd}) + 1 ELSE 0 END) AS od_days,
    CASE WHEN GREATEST(CASE WHEN p_od_dt IS NOT NULL THEN date_diff('day', p_od_dt, {dd}) + 1 ELSE 0 END,
             CASE WHEN i_od_dt IS NOT NULL THEN date_diff('day', i_od_dt, {dd}) + 1 ELSE 0 END) > 0 THEN 'Y' ELSE 'N' END AS od_flg,
    CASE WHEN loan_sts = 'F' THEN '03' ELSE '01' END AS acct_sts,
    NULL::DATE AS p_od_dt, NULL::DATE AS i_od_dt, NULL::DECIMAL(20,2) AS year_int_incom,
    NULL::DECIMAL(20,2) AS od_loan_acct_bal, NULL::VARCHAR AS draft_nbr, NULL::VARCHAR AS is_first_loan_tag
  FROM {b} WHERE priority = '1-URGENT'
  UNION ALL
  SELECT loan_num, 'PL_2', cust_id, drawdown_dt, loan_amt, NULL, date_diff('day', p_od_dt, {dd}), NULL, NULL,
    p_od_dt, i_od_dt, ytd_int, NULL, NULL, NULL
  FROM {b} WHERE priority = '2-HIGH'
  UNION ALL
  SELECT loan_num, 'NL_3', cust_id, drawdown_dt, loan_amt, NULL, NULL, NULL,
    CASE loan_sts WHEN 'F' THEN '03' WHEN 'O' THEN '01' WHEN 'P' THEN '02' END,
    NULL, NULL, NULL, od_prcp_amt, NULL, NULL
  FROM {b} WHERE priority = '3-MEDIUM'
  UNION ALL
  SELECT loan_num, 'WBYXNL_4', cust_id, drawdown_dt, loan_amt, maturity_dt, NULL,
    CASE WHEN p_od_dt IS NOT NULL THEN 'Y' ELSE 'N' END, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM {b} WHERE priority = '4-NOT SPECIFIED'
  UNION ALL
  SELECT loan_num, 'BS_5', cust_id, drawdown_dt, loan_amt, NULL,
    CASE WHEN maturity_dt < {dd} THEN date_diff('day', maturity_dt, {dd}) ELSE 0 END, NULL, NULL,
    NULL, NULL, NULL, NULL, 'B' || CAST(loan_num AS VARCHAR), NULL
  FROM {b} WHERE priority = '5-LOW' AND loan_sts = 'F'
  UNION ALL
  SELECT loan_num, 'XL_6', cust_id, drawdown_dt, loan_amt, NULL, NULL, NULL, NULL,
    NULL, NULL, ytd_int, NULL, NULL, CASE WHEN loan_amt > 100000 THEN '1' ELSE '2' END
  FROM {b} WHERE priority = '5-LOW' AND NOT (loan_sts = 'F')),
{name} AS (
  SELECT CAST(loan_num AS VARCHAR) AS loan_num, date_sourcesd, '{d8}' AS data_date, CAST(cust_id AS VARCHAR) AS cust_id,
    drawdown_dt, CAST(drawdown_amt AS DECIMAL(20,2)) AS drawdown_amt, maturity_dt, CAST(od_days AS INTEGER) AS od_days,
    od_flg, acct_sts, p_od_dt, i_od_dt, CAST(year_int_incom AS DECIMAL(20,2)) AS year_int_incom,
    CAST(od_loan_acct_bal AS DECIMAL(20,2)) AS od_loan_acct_bal, draft_nbr, is_first_loan_tag,
    CASE WHEN ROW_NUMBER() OVER (PARTITION BY CAST(cust_id AS VARCHAR)
                                 ORDER BY drawdown_dt, CAST(loan_num AS VARCHAR)) = 1 THEN 'Y' ELSE 'N' END
      AS is_first_report_loan_tag
  FROM {name}_u)"""


_OUT_SQL = ", ".join(OUT_COLS)


def ledger_slice_by_union(t: Tables, run: RunDate) -> DataFrame:
    """The same slice built the way the ledger job builds it from separate
    source systems: one frame per segment, each conformed to the ledger and
    unioned by name, then flagged. A test holds it against ``ledger_slice``."""
    base = base_measures(t, run)
    return flag_first_loan(union_segments(segments(base, run), run.d8))


def narrow_slice(t: Tables, run: RunDate) -> DataFrame:
    """The slice's rows with the columns the segments fill, without the flag."""
    return conform(split_segments(base_measures(t, run), segment_specs(run), run.d8, schema=None), fill_missing=False)


@query("ledger_union", with_sql(SCHED_SQL, _ledger_sql("1998-06-30")) + f"""
SELECT {_OUT_SQL} FROM ledger""")
def ledger_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one input here, so one pass; union_segments is for separate source systems
    return ledger_slice(tables(spark, sf_dir), RUN).select(*OUT_COLS)


@query("segment_rowcounts", with_sql(SCHED_SQL, _ledger_sql("1998-06-30")) + """
SELECT date_sourcesd, COUNT(*) AS row_count FROM ledger GROUP BY date_sourcesd""")
def segment_rowcounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows affected per load, observed while the slice is written (here to a sink
    that keeps nothing), as the job does it; one row of counts reaches the driver."""
    log = RunLog(RUN.d8, "segment_rowcounts")
    tags = [tag for tag, _, _ in segment_specs(RUN)]
    written, counts = log.observe(narrow_slice(tables(spark, sf_dir), RUN), "segment_rowcounts", {
        tag: F.count(F.when(F.col("date_sourcesd") == tag, F.lit(1))) for tag in tags})
    written.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(tag, int(counts.get[tag])) for tag in tags if counts.get[tag]], "date_sourcesd string, row_count long")


PRIOR = RunDate(RUN.prior_month)
#: Buckets of a stored slice; on a cluster about its bytes / 128 MB, the same for all dates.
SLICE_BUCKETS = 8
_OUT = T.StructType([LEDGER[c] for c in OUT_COLS])


def _scratch_ledger(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/lendgrid-ledger-{uuid.uuid4().hex}"


@query("prior_period_lookup", with_sql(SCHED_SQL, _ledger_sql("1998-06-30"),
                                       _ledger_sql(PRIOR.d.isoformat(), "prior")) + """
SELECT c.loan_num, c.date_sourcesd, c.od_days, p.od_days AS prev_od_days,
  CASE WHEN p.loan_num IS NULL THEN 'Y' ELSE 'N' END AS new_loan_flg
FROM ledger c LEFT JOIN prior p ON p.loan_num = c.loan_num AND p.date_sourcesd = c.date_sourcesd""")
def prior_period_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current rows against the slice stored for the month before, of which
    only the keys and the measure are read."""
    t = tables(spark, sf_dir)
    root = _scratch_ledger(spark)
    replace_slice(narrow_slice(t, PRIOR).select("loan_num", "od_days", "data_date", "date_sourcesd"), root, ["data_date", "date_sourcesd"])
    kept = T.StructType([LEDGER[c] for c in ("loan_num", "od_days", "data_date", "date_sourcesd")])
    prev = read_slice(spark, root, kept, data_date=PRIOR.d8).select(
        F.col("loan_num").alias("p_loan"), F.col("date_sourcesd").alias("p_src"), F.col("od_days").alias("prev_od_days"))
    cur = narrow_slice(t, RUN).select("loan_num", "date_sourcesd", "od_days")
    j = cur.join(prev, (F.col("p_loan") == F.col("loan_num")) & (F.col("p_src") == F.col("date_sourcesd")), "left")
    return j.select("loan_num", "date_sourcesd", "od_days", "prev_od_days",
                    F.when(F.col("p_loan").isNull(), "Y").otherwise("N").alias("new_loan_flg"))


@query("colocated_slices", with_sql(SCHED_SQL, _ledger_sql("1998-06-30"), _ledger_sql(PRIOR.d.isoformat(), "prior")) + """
SELECT c.loan_num, c.date_sourcesd, c.od_days, p.od_days AS prev_od_days, p.p_od_dt AS prev_p_od_dt
FROM ledger c LEFT JOIN prior p ON p.loan_num = c.loan_num AND p.date_sourcesd = c.date_sourcesd""")
def colocated_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored slices, dealt and sorted by the row key when they were written, joined as they lie."""
    t = tables(spark, sf_dir)
    root, keys = _scratch_ledger(spark), ["loan_num", "date_sourcesd"]

    def stored(run: RunDate) -> DataFrame:
        rows = narrow_slice(t, run).select(*keys, "od_days", "p_od_dt")
        return write_bucketed(rows, f"slice_{run.d8}_{uuid.uuid4().hex}", f"{root}/{run.d8}", keys, SLICE_BUCKETS)

    prior = stored(PRIOR).withColumnsRenamed({"od_days": "prev_od_days", "p_od_dt": "prev_p_od_dt"})
    return stored(RUN).hint("merge").join(prior, keys, "left").select(*keys, "od_days", "prev_od_days", "prev_p_od_dt")


@query("replace_slice", with_sql(SCHED_SQL, _ledger_sql("1998-06-30"), _ledger_sql(PRIOR.d.isoformat(), "prior")) + f"""
SELECT {_OUT_SQL} FROM ledger UNION ALL SELECT {_OUT_SQL} FROM prior""")
def replace_slice_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the slices of two dates into the shared folder, load one segment of
    the current date again, and read everything back. The result must equal both
    dates' ledgers: nothing twice, the other segments and the other date untouched."""
    t = tables(spark, sf_dir)
    root = _scratch_ledger(spark)
    by = ["data_date", "date_sourcesd"]
    current = ledger_slice(t, RUN).select(*OUT_COLS)
    replace_slice(ledger_slice(t, PRIOR).select(*OUT_COLS).unionByName(current), root, by)
    # the rerun of one segment, from the rows as they are stored (cut off from the files it replaces)
    again = read_slice(spark, root, _OUT, data_date=RUN.d8, date_sourcesd="PL_2").select(*OUT_COLS).checkpoint()
    replace_slice(again, root, by)
    return read_slice(spark, root, _OUT).select(*OUT_COLS)


@query("publish_slices", with_sql(SCHED_SQL, _ledger_sql("1998-06-30"), _ledger_sql(PRIOR.d.isoformat(), "prior")) + f"""
SELECT {_OUT_SQL} FROM ledger UNION ALL SELECT {_OUT_SQL} FROM prior""")
def publish_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve slices (two dates, six systems) published by one write to the manifest, then
    two of them again, then a run that dies before its publication. Readers must see
    both dates whole: nothing twice, nothing of the run that died."""
    t = tables(spark, sf_dir)
    store = PublishedSlices(spark, _scratch_ledger(spark), _OUT, ["data_date", "date_sourcesd"])
    version = store.stage(ledger_slice(t, PRIOR).select(*OUT_COLS).unionByName(ledger_slice(t, RUN).select(*OUT_COLS)))
    store.publish(store.staged_counts(version), version)
    again = store.stage(store.read(data_date=RUN.d8).where(F.col("date_sourcesd").isin("PL_2", "BS_5")))
    store.publish({(RUN.d8, "PL_2"): 0, (RUN.d8, "BS_5"): 0} | store.staged_counts(again), again)
    store.stage(store.read(date_sourcesd="CL_1").withColumn("od_days", F.lit(-1)))
    return store.read().select(*OUT_COLS)


@query("first_loan_update", with_sql(SCHED_SQL, _ledger_sql("1998-06-30")) + f"""
SELECT {_OUT_SQL} FROM ledger""")
def first_loan_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date loaded by the ledger job in three partial runs. Each derives the first loans of
    the whole date and updates the marks of the other systems' rows it changes, so the
    result equals one load of all six."""
    base = base_measures(tables(spark, sf_dir), RUN).checkpoint()  # read by all six segments
    own = segments(base, RUN)
    root = _scratch_ledger(spark)
    for tags in (("CL_1", "XL_6"), ("NL_3", "BS_5"), ("PL_2", "WBYXNL_4")):
        LedgerJob(spark, None, RUN, root, {tag: (lambda catalog, run, rows=own[tag]: rows) for tag in tags}).execute()
    return read_ledger(spark, root, data_date=RUN.d8).select(*OUT_COLS)


@query("loan_overview", with_sql(SCHED_SQL) + """,
loans AS (SELECT o_orderkey AS loan_num, o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS drawdown_dt,
                 CAST(o_totalprice AS DECIMAL(18,2)) AS loan_amt, o_orderstatus AS loan_sts
          FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01'),
a AS (SELECT loan_num,
        MIN(due_dt) FILTER (WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30') AS earliest_unpaid_dt,
        MIN(due_dt) FILTER (WHERE line_sts = 'O' AND due_dt <= DATE '1998-06-30') AS i_od_dt,
        SUM(prcp_amt) FILTER (WHERE rtn_flag = 'N' AND due_dt <= DATE '1998-06-30') AS od_prcp_amt
      FROM sched GROUP BY loan_num),
b AS (SELECT l.*, c.c_name AS cust_nam, a.earliest_unpaid_dt, a.od_prcp_amt,
        GREATEST(CASE WHEN a.earliest_unpaid_dt IS NOT NULL THEN date_diff('day', a.earliest_unpaid_dt, DATE '1998-06-30') + 1 ELSE 0 END,
                 CASE WHEN a.i_od_dt IS NOT NULL THEN date_diff('day', a.i_od_dt, DATE '1998-06-30') + 1 ELSE 0 END) AS od_days
      FROM loans l LEFT JOIN a ON a.loan_num = l.loan_num LEFT JOIN customer c ON c.c_custkey = l.cust_id)
SELECT loan_num, cust_id, cust_nam, drawdown_dt, loan_amt,
  CASE WHEN loan_sts = 'F' THEN '03' WHEN od_days > 90 THEN '02' WHEN od_days > 0 THEN '04' ELSE '01' END AS acct_sts,
  earliest_unpaid_dt, od_days, CASE WHEN od_days > 0 THEN 'Y' ELSE 'N' END AS od_flg, od_prcp_amt,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY drawdown_dt, loan_num) = 1 THEN 'Y' ELSE 'N' END AS is_first_loan
FROM b""")
def loan_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: every loan as of D with its earliest unpaid due date, days
    overdue, account status, customer name and first-loan flag."""
    t = tables(spark, sf_dir)
    due = F.col("due_dt") <= F.lit(RUN.d)
    j = agg_join(loans(t), schedule(t), ["loan_num"], [
        F.min(F.when((F.col("rtn_flag") == "N") & due, F.col("due_dt"))).alias("earliest_unpaid_dt"),
        F.min(F.when((F.col("line_sts") == "O") & due, F.col("due_dt"))).alias("i_od_dt"),
        money_sum(F.when((F.col("rtn_flag") == "N") & due, F.col("prcp_amt"))).alias("od_prcp_amt"),
    ])
    c = t.read("customer", "c_custkey", "c_name")
    j = j.join(c, F.col("cust_id") == c.c_custkey, "left")
    j = j.withColumn("od_days", overdue_days(RUN.d, "earliest_unpaid_dt", "i_od_dt"))
    j = first_flag(j, ["cust_id"], ["drawdown_dt", "loan_num"], ["loan_num"], "is_first_loan")
    od = F.col("od_days")
    sts = F.when(F.col("loan_sts") == "F", "03").when(od > 90, "02").when(od > 0, "04").otherwise("01")
    return j.select("loan_num", "cust_id", F.col("c_name").alias("cust_nam"), "drawdown_dt", "loan_amt",
                    sts.alias("acct_sts"), "earliest_unpaid_dt", F.col("od_days").cast("bigint").alias("od_days"),
                    F.when(od > 0, "Y").otherwise("N").alias("od_flg"), "od_prcp_amt", "is_first_loan")
