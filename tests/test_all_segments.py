"""All six source-system segments, each built from its own fixture, unioned
into one ledger slice with the first-loan flag."""

from pyspark.sql import functions as F

import test_bill_segment as bills
import test_corporate_segment as corporate
import test_micro_segment as micro
import test_online_segment as online
import test_personal_segment as personal
import test_tax_segment as tax
from lendgrid.operators.ledger import LEDGER, SEGMENT_TAGS, flag_first_loan, union_segments
from lendgrid.rundate import RunDate
from lendgrid.segments import SEGMENTS, Catalog

RUN = RunDate.parse("2024-01-31")


def test_six_segments_union_into_one_slice(spark):
    cat = {
        "CL_1": Catalog.frames(corporate.frames(spark)),
        "PL_2": Catalog.frames(personal.build_frames(spark)),
        "NL_3": Catalog.frames(online.build_frames(spark)),
        "WBYXNL_4": Catalog.frames(tax.build_frames(spark)),
        "BS_5": Catalog.frames(bills.build_frames(spark)),
        "XL_6": Catalog.frames(micro.build_frames(spark)),
    }
    frames = {tag: SEGMENTS[tag](cat[tag], RUN) for tag in SEGMENT_TAGS}
    led = flag_first_loan(union_segments(frames, RUN.d8)).cache()
    assert [(f.name, f.dataType) for f in led.schema] == [(f.name, f.dataType) for f in LEDGER]
    counts = {r.date_sourcesd: r["count"] for r in led.groupBy("date_sourcesd").count().collect()}
    assert counts == {"CL_1": 3, "PL_2": 3, "NL_3": 4, "WBYXNL_4": 4, "BS_5": 3, "XL_6": 2}
    firsts = led.where(F.col("is_first_report_loan_tag") == "Y").groupBy("cust_id").count()
    assert firsts.where("count > 1").count() == 0
    led.unpersist()


def test_ledger_job_runs_all_segments(spark):
    """One LedgerJob run: detail written and read back, six segments (each on
    its own fixture catalogue), union, first-loan flag, slice write, rerun."""
    import os
    import tempfile

    from lendgrid.job import LedgerJob, read_ledger

    pl_frames = personal.build_frames(spark)
    detail = pl_frames.pop("URDM.PL_LBI_R_LOAN_DETAIL_HS")
    own = {
        "CL_1": Catalog.frames(corporate.frames(spark)), "NL_3": Catalog.frames(online.build_frames(spark)),
        "WBYXNL_4": Catalog.frames(tax.build_frames(spark)), "BS_5": Catalog.frames(bills.build_frames(spark)),
        "XL_6": Catalog.frames(micro.build_frames(spark)),
    }
    # PL_2 uses the job's catalogue (it reads the detail the job writes); the
    # others are bound to their own fixture catalogues
    segments = {tag: (SEGMENTS[tag] if tag == "PL_2" else (lambda cat, run, fn=SEGMENTS[tag], c=own[tag]: fn(c, run)))
                for tag in SEGMENT_TAGS}
    root = tempfile.mkdtemp(prefix="lendgrid-all-")
    job = LedgerJob(spark, Catalog.frames(pl_frames), RUN, os.path.join(root, "ledger"), segments,
                    run_log=os.path.join(root, "log"),
                    detail=lambda cat, run: detail.where(detail.rpt_dt == run.d),
                    detail_target=os.path.join(root, "detail"))
    expected = {"CL_1": 3, "PL_2": 3, "NL_3": 4, "WBYXNL_4": 4, "BS_5": 3, "XL_6": 2}
    assert job.execute() == expected
    assert job.execute() == expected                      # rerun replaces the slice
    led = read_ledger(spark, os.path.join(root, "ledger"), data_date=RUN.d8)
    assert led.count() == sum(expected.values())
    log = spark.read.parquet(os.path.join(root, "log"))
    assert log.where("step_flag = -1").count() == 0 and log.where("step_desc = 'done'").count() == 2
