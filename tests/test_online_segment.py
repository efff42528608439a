"""NL_3 (online loans) on hand-built source tables, and the ledger job."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from lendgrid.job import LedgerJob, read_ledger
from lendgrid.operators.ledger import LEDGER
from lendgrid.rundate import RunDate
from lendgrid.segments import Catalog, online_loans

RUN = RunDate(dt.date(2024, 1, 31))
B, O, P = dt.date(2024, 1, 1), dt.date(9999, 12, 31), "202401"
H = "begndt date, overdt date, partid string"


def hist(spark, rows, schema):
    return spark.createDataFrame([(*r, B, O, P) for r in rows], schema + ", " + H)


def build_frames(spark):
    loan_s = ("serialno string, loanstatus string, productid string, customerid string, contractserialno string, "
              "accountingorgid string, classifyresult string, putoutdate string, maturitydate string, "
              "originalmaturitydate string, finishdate string, businesssum decimal(20,2), "
              "normalbalance decimal(20,2), overduebalance decimal(20,2), overduedays int, "
              "overdueinterest decimal(20,2), accruedinterest decimal(20,2)")
    d = Decimal
    loans = [
        ("L1", "1", "1010010", "C1", "K1", "O1", "02", "2023/06/15", "2025/06/15", "2025/06/15", None,
         d("100000"), d("50000"), d("2000"), 20, d("30"), d("12.5")),
        ("L2", "0", "1030010", "C2", "K2", "O1", None, "20231001", "20241001", "20241001", None,
         d("20000"), d("18000"), None, 0, d("0"), None),
        ("L3", "3", "X", "C3", "K3", "O2", "09", "2023-01-10", "2024-01-10", "2024-01-10", "2024/01/10",
         d("5000"), d("0"), d("0"), 0, d("0"), None),
        ("L4", "6", "1010010", "C1", "K1", "O1", None, "2024/01/02", None, None, None,
         d("1"), None, None, 0, None, None),
        ("L6", "8", "1010010", "C1", "K1", "O1", "05", "2023/12/01", None, None, None,
         None, None, None, 0, None, None),
    ]
    loan_rows = [(*r, B, O, P) for r in loans]
    loan_rows.append(("L5", "1", "X", "C9", None, None, None, "2023/01/01", None, None, None,
                      None, None, None, 0, None, None, B, RUN.d, P))            # expired on D
    loan_rows.append((*loans[0][:1], "0", *loans[0][2:], B, O, "202312"))       # stale partition
    sched_s = ("relativeobjectno string, relativeobjecttype string, serialno string, periodno int, paydate string, "
               "payprincipalamt decimal(20,2), actualpayprincipalamt decimal(20,2), payinterestamt decimal(20,2), "
               "actualpayinterestamt decimal(20,2), payinterestpenaltyamt decimal(20,2), "
               "actualpayinterestpenaltyamt decimal(20,2), payprincipalpenaltyamt decimal(20,2), "
               "actualpayprincipalpenaltyamt decimal(20,2), finishdate string")
    LO = "jbo.acct.ACCT_LOAN"
    z, k, f = d("0"), d("1000"), d("50")
    sched = [
        ("L1", LO, "S1", 1, "2023/12/15", k, k, f, z, z, z, z, z, None),
        ("L1", LO, "S2", 2, "2024/01/15", k, z, f, z, z, z, z, z, None),
        ("L1", LO, "S3", 3, "2024/02/15", k, z, f, z, z, z, z, z, None),
        ("L2", LO, "S4", 1, "2024/01/05", k, k, f, f, z, z, z, z, "2024/01/05"),
        ("L2", LO, "S5", 2, "2024/02/05", k, z, f, z, z, z, z, z, None),
        ("L2", "jbo.other", "S6", 9, "2024/01/20", d("10"), z, z, z, z, z, z, z, None),
        ("L3", LO, "S7", 1, "2023/11/01", k, k, f, f, z, z, z, z, "2023/11/01"),
        ("L3", LO, "S8", 2, "2023/12/01", k, k, f, f, z, z, z, z, "2023/12/01"),
    ]
    log_s = ("relativeobjectno string, actualpaydate string, actualpayinterestamt decimal(20,2), "
             "actualpayprincipalpenaltyamt decimal(20,2), actualpayinterestpenaltyamt decimal(20,2)")
    logs = [("L1", "2024/01/15", d("10"), d("1"), d("2")), ("L1", "2023/12/15", d("5"), z, z),
            ("L2", "20240105", d("7"), None, d("1"))]
    frames = {
        "OMI.NL_ACCT_LOAN_HS": spark.createDataFrame(loan_rows, loan_s + ", " + H),
        "OMI.NL_BUSINESS_CONTRACT_CFS_HS": hist(spark, [
            ("K1", "4", "WH", "A01", 24), ("K2", "5", "SH", "B02", 12), ("K3", "9", None, None, 12)],
            "serialno string, purposetype string, city string, direction string, businesstermmonth int"),
        "OMI.NL_ORG_INFO_CFS_HS": hist(spark, [("O1", "M001")], "orgid string, mainframeorgid string"),
        "OMI.NL_CUSTOMER_INFO_CFS_HS": hist(spark, [("C1", "MF1", "ID1"), ("C2", None, "ID2"), ("C3", "MF3", None)],
                                           "customerid string, mfcustomerid string, certid string"),
        "OMI.KN_KCFB_CFDSJC_HS": hist(spark, [("ID1", "P1")], "zhjhaoma string, kehuhaoo string"),
        "OMI.NL_CODE_LIBRARY_CFS_HS": hist(spark, [
            ("ClassifyResult", "01", "正常"), ("ClassifyResult", "02", "关注"), ("ClassifyResult", "05", "weird"),
            ("CreditPurposeType", "4", "经营"), ("Other", "02", "x")],
            "codeno string, itemno string, itemname string"),
        "OMI.NL_ACCT_RATE_SEGMENT_HS": hist(spark, [
            ("L1", LO, "01", d("3.45"), d("4.35"), "090"), ("L1", LO, "02", d("9"), d("9"), "090")],
            "objectno string, objecttype string, ratetype string, baserate decimal(12,6), "
            "businessrate decimal(12,6), baseratetype string"),
        "OMI.NL_ACCT_RPT_SEGMENT_HS": hist(spark, [("L1", LO, "RPT-04"), ("L2", LO, "RPT-99")],
                                          "objectno string, objecttype string, termid string"),
        "OMI.NL_ACCT_BUSINESS_ACCOUNT_HS": hist(spark, [("L1", LO, "B1", "N1", "A1"), ("L2", LO, None, None, "A2")],
                                               "objectno string, objecttype string, banksettlecode string, "
                                               "accountname string, accountno string"),
        "OMI.NL_ACCT_PAYMENT_SCHEDULE_HS": spark.createDataFrame([(*r, B, O, P) for r in sched], sched_s + ", " + H),
        "OMI.NL_ACCT_PAYMENT_LOG_HS": spark.createDataFrame([(*r, B, O, P) for r in logs], log_s + ", " + H),
        "OMI.KN_KDPA_ZHDUIZ_HS": hist(spark, [("A1", "Z2", 2), ("A1", "Z1", 1)],
                                      "kehuzhao string, zhanghao string, zhhaoxuh int"),
    }
    return frames


@pytest.fixture(scope="module")
def catalog(spark):
    return Catalog.frames(build_frames(spark))


def test_online_segment_rows(spark, catalog):
    rows = {r.loan_num: r for r in online_loans(catalog, RUN).collect()}
    assert set(rows) == {"L1", "L2", "L3", "L6"}          # failed and expired loans excluded
    l1, l2, l3, l6 = rows["L1"], rows["L2"], rows["L3"], rows["L6"]
    assert (l1.acct_sts, l2.acct_sts, l3.acct_sts, l6.acct_sts) == ("2", "1", "3", "9")
    assert (l1.acct_sts_desc, l6.acct_sts_desc) == (None, "其他")
    assert (l1.acct_typ, l2.acct_typ, l3.acct_typ) == ("010299", "010399", "010399")
    assert (l1.acct_typ_desc, l2.acct_typ_desc, l3.acct_typ_desc) == ("个人经营性贷款", "个人消费性贷款", "互联网贷款")
    assert (l1.cust_id, l2.cust_id, l3.cust_id) == ("P1", "C2", "MF3")
    assert (l1.loan_grade_cd, l2.loan_grade_cd, l3.loan_grade_cd, l6.loan_grade_cd) == ("2", "1", "1", None)
    assert l1.p_od_dt == dt.date(2024, 1, 15) and l1.i_od_dt == dt.date(2023, 12, 15)
    assert l2.p_od_dt == dt.date(2024, 1, 20) and l2.i_od_dt is None       # no object-type filter there
    assert (l1.next_int_pay_dt, l2.next_int_pay_dt) == (dt.date(2024, 2, 15), dt.date(2024, 2, 5))
    assert (l1.consecute_term_num, l1.cumulate_term_num) == (3, 3)
    assert (l2.consecute_term_num, l2.cumulate_term_num) == (0, 0)
    assert (l1.current_term_num, l2.current_term_num, l3.current_term_num, l6.current_term_num) == (3, 2, 2, 0)
    assert l1.year_int_incom == Decimal("13") and l2.year_int_incom is None and l3.year_int_incom is None
    assert (l1.base_int_rat, l1.real_int_rat, l1.pricing_base_type) == (Decimal("3.45"), Decimal("4.35"), "C")
    assert (l2.base_int_rat, l2.real_int_rat, l2.pricing_base_type) == (None, 0, "Z99")
    assert (l1.repay_typ, l1.repay_typ_desc) == ("5", "")
    assert (l2.repay_typ, l2.repay_typ_desc) == ("7", "其他")
    assert (l3.repay_typ, l3.repay_typ_desc) == ("7", "")
    assert (l1.loan_acct_num, l1.pay_acct_num, l2.loan_acct_num) == ("Z1", "Z1", "A2")
    assert (l1.consume_loan_add_type, l2.consume_loan_add_type, l3.consume_loan_add_type) == ("B", "A", "")
    assert l1.useofunds == "经营" and l2.useofunds is None
    assert (l1.drawdown_dt, l2.drawdown_dt, l3.drawdown_dt) == (
        dt.date(2023, 6, 15), dt.date(2023, 10, 1), dt.date(2023, 1, 10))
    assert l3.finish_dt == dt.date(2024, 1, 10) and l3.actual_maturity_dt == dt.date(2024, 1, 10)
    assert (l1.loan_acct_bal, l3.loan_acct_bal) == (Decimal("52000"), 0)
    assert (l1.od_flg, l2.od_flg) == ("Y", "N")
    assert (l1.generalize_loan_flg, l2.generalize_loan_flg, l3.generalize_loan_flg) == ("Y", "N", None)
    assert (l1.item_cd, l2.item_cd) == ("11050201", "11040401")
    assert l1.org_num == "M001" and l3.org_num is None
    assert l1.loan_ratio == "100%" and l1.departmentd == "xwdk"


def test_ledger_job_writes_slice_idempotently(spark, catalog):
    root = tempfile.mkdtemp(prefix="lendgrid-job-")
    target, runlog = os.path.join(root, "l_acct_loan"), os.path.join(root, "run_log")
    job = LedgerJob(spark, catalog, RUN, target, {"NL_3": online_loans}, run_log=runlog)
    assert job.execute() == {"NL_3": 4}
    assert job.execute() == {"NL_3": 4}                    # rerun replaces the slice
    led = read_ledger(spark, target, data_date=RUN.d8)
    assert led.count() == 4
    firsts = {r.loan_num: r.is_first_report_loan_tag for r in led.collect()}
    # L1 and L6 both resolve to customer P1; L1 is drawn first
    assert firsts == {"L1": "Y", "L2": "Y", "L3": "Y", "L6": "N"}
    log = spark.read.parquet(runlog)
    assert log.where("step_flag = 1 AND step_desc = 'load NL_3'").select("row_count").distinct().collect()[0][0] == 4


def test_unknown_paid_amounts_are_not_overdue(spark):
    from pyspark.sql import functions as F

    own = build_frames(spark)
    name = "OMI.NL_ACCT_PAYMENT_SCHEDULE_HS"
    null = F.lit(None).cast("decimal(20,2)")
    own[name] = own[name].withColumns({"actualpayprincipalamt": null, "actualpayinterestamt": null})
    rows = {r.loan_num: r for r in online_loans(Catalog.frames(own), RUN).collect()}
    assert all(rows[k].p_od_dt is None and rows[k].i_od_dt is None for k in ("L1", "L2", "L3"))


def test_partial_and_empty_runs(spark, catalog):
    """A run of one segment keeps the date's others and other dates; a segment
    without rows has its slice emptied; marks are set over the whole date."""
    from pyspark.sql import functions as F

    root = os.path.join(tempfile.mkdtemp(prefix="lendgrid-part-"), "ledger")

    def early(cat, run):  # P1 has an earlier loan here than L1
        return spark.createDataFrame([("X1", "P1", dt.date(2020, 1, 1))], "loan_num string, cust_id string, drawdown_dt date")

    def nothing(cat, run):
        return early(cat, run).where("loan_num = 'none'")

    def stored(date=RUN.d8):
        return {(r.date_sourcesd, r.loan_num): r.is_first_report_loan_tag for r in read_ledger(spark, root, data_date=date).collect()}

    other_day = RunDate.parse("20240229")
    LedgerJob(spark, catalog, other_day, root, {"XL_6": early}).execute()
    assert LedgerJob(spark, catalog, RUN, root, {"NL_3": online_loans}).execute() == {"NL_3": 4}
    assert stored()["NL_3", "L1"] == "Y"
    assert LedgerJob(spark, catalog, RUN, root, {"XL_6": early}).execute() == {"XL_6": 1}
    assert len(stored()) == 5 and stored()["XL_6", "X1"] == "Y" and stored()["NL_3", "L1"] == "N"
    assert LedgerJob(spark, catalog, RUN, root, {"XL_6": nothing}).execute() == {"XL_6": 0}
    assert {k for k, _ in stored()} == {"NL_3"} and stored()["NL_3", "L1"] == "Y"
    assert LedgerJob(spark, catalog, RUN, root, {"NL_3": lambda c, r: online_loans(c, r).where(F.lit(False))}).execute() == {"NL_3": 0}
    assert stored() == {} and stored("20240229") == {("XL_6", "X1"): "Y"}


def test_ledger_job_logs_failure_and_reraises(spark, catalog):
    root = tempfile.mkdtemp(prefix="lendgrid-fail-")

    def broken(cat, run):
        return cat.snapshot("OMI.NO_SUCH_TABLE", run)

    job = LedgerJob(spark, catalog, RUN, os.path.join(root, "ledger"), {"NL_3": online_loans, "XL_6": broken},
                    run_log=os.path.join(root, "log"))
    with pytest.raises(KeyError):
        job.execute()
    log = spark.read.parquet(os.path.join(root, "log"))
    assert log.where("step_flag = -1").count() == 1 and log.where("step_flag = 1").count() == 0
    assert not os.path.exists(os.path.join(root, "ledger"))   # nothing written


def test_command_line_run_from_parquet_folders(spark, capsys):
    import json

    from lendgrid.job import main

    root = tempfile.mkdtemp(prefix="lendgrid-cli-")
    for name, df in build_frames(spark).items():
        df.write.mode("overwrite").parquet(os.path.join(root, "src", name.lower()))
    argv = ["--date", "20240131", "--target", os.path.join(root, "ledger"), "--detail-target",
            os.path.join(root, "detail"), "--run-log", os.path.join(root, "log"),
            "--parquet-root", os.path.join(root, "src"), "--segments", "NL_3"]
    assert main(argv) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"data_date": "20240131", "rows": {"NL_3": 4}}
    assert read_ledger(spark, os.path.join(root, "ledger"), data_date="20240131").count() == 4
