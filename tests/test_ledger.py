import datetime as dt

from pyspark.sql import functions as F

from lendgrid.operators.ledger import LEDGER, LEDGER_COLUMNS, SEGMENT_TAGS, flag_first_loan, union_segments
from lendgrid.plans.frames import RUN, tables
from lendgrid.plans.ledger import ledger_slice

SF = "/root/testdata/sf0.001"


def test_schema_has_137_columns():
    assert len(LEDGER_COLUMNS) == 137 == len(set(LEDGER_COLUMNS))


def test_union_missing_columns_null_and_typed(spark):
    a = spark.createDataFrame([("L1", "c1", dt.date(2024, 1, 1))], "loan_num string, cust_id string, drawdown_dt date")
    b = spark.createDataFrame([("L2", "c1", 5)], "loan_num string, cust_id string, od_days int")
    led = union_segments({"CL_1": a, "XL_6": b}, "20240131")
    assert [(f.name, f.dataType) for f in led.schema] == [(f.name, f.dataType) for f in LEDGER]
    rows = {r.loan_num: r for r in led.collect()}
    assert rows["L1"].od_days is None and rows["L2"].drawdown_dt is None
    assert rows["L2"].date_sourcesd == "XL_6" and rows["L1"].data_date == "20240131"


def test_ledger_invariants(spark):
    led = ledger_slice(tables(spark, SF), RUN).cache()
    n = led.count()
    assert n > 0
    assert led.select("loan_num", "date_sourcesd", "data_date").distinct().count() == n
    assert {r[0] for r in led.select("date_sourcesd").distinct().collect()} <= set(SEGMENT_TAGS)
    firsts = led.where(F.col("is_first_report_loan_tag") == "Y").groupBy("cust_id").count()
    assert firsts.where("count != 1").count() == 0
    assert firsts.count() == led.select("cust_id").distinct().count()
    assert led.where(~F.col("is_first_report_loan_tag").isin("Y", "N")).count() == 0
    assert led.where((F.col("date_sourcesd") == "CL_1") & (F.col("od_flg") == "N") & (F.col("od_days") > 0)).count() == 0
    led.unpersist()


def test_flag_keeps_existing_values(spark):
    led = union_segments({"XL_6": spark.createDataFrame(
        [("L1", "c", dt.date(2024, 1, 1), "N"), ("L2", "c", dt.date(2024, 1, 2), "N")],
        "loan_num string, cust_id string, drawdown_dt date, is_first_report_loan_tag string")}, "20240131")
    got = {r.loan_num: r.is_first_report_loan_tag for r in flag_first_loan(led).collect()}
    assert got == {"L1": "Y", "L2": "N"}


def test_split_segments_equals_union(spark):
    from lendgrid.operators.ledger import split_segments
    from lendgrid.plans.ledger import base_measures, segment_specs, segments
    t = tables(spark, SF)
    base = base_measures(t, RUN)
    one_pass = split_segments(base, segment_specs(RUN), RUN.d8)
    unioned = union_segments(segments(base, RUN), RUN.d8)
    assert one_pass.exceptAll(unioned).count() == 0 and unioned.exceptAll(one_pass).count() == 0


def test_single_pass_slice_equals_the_union_of_segments(spark):
    from lendgrid.plans.frames import RUN, tables
    from lendgrid.plans.ledger import OUT_COLS, ledger_slice, ledger_slice_by_union

    t = tables(spark, "/root/testdata/sf0.001")
    one, two = (f(t, RUN).select(*OUT_COLS) for f in (ledger_slice, ledger_slice_by_union))
    assert one.count() > 0 and one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
