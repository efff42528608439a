import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lendgrid.functions import (
    concat_null_as_empty, decode, effective_rate, in_code_set, norm_date, overdue_days, rate_text, term_months,
    text_after,
)
from lendgrid.rundate import RunDate

D = dt.date(2024, 1, 31)


def test_f6_norm_date_all_layouts(spark):
    df = spark.createDataFrame([(s,) for s in ["20240131", "2024-01-31", "2024/01/31", "", "null", None, "20240230"]],
                               "s string")
    got = [r[0] for r in df.select(norm_date("s")).collect()]
    assert got == [D, D, D, None, None, None, None]


def test_rundate_derivations():
    r = RunDate.parse("2024-03-31")
    assert r.d8 == "20240331" and r.partid == "202403"
    assert r.prior_month == dt.date(2024, 2, 29)
    assert RunDate.parse("20240229").add_months(1) == dt.date(2024, 3, 29)
    assert r.year_start == dt.date(2024, 1, 1) and r.month_end == dt.date(2024, 3, 31)


def test_f8_term_months(spark):
    rows = [(dt.date(2024, 1, 31), dt.date(2024, 4, 30)),   # both month ends -> 3
            (dt.date(2023, 3, 1), dt.date(2024, 3, 1)),     # same day, leap year -> 12
            (dt.date(2024, 1, 15), dt.date(2024, 2, 16)),   # partial forward -> 2
            (dt.date(2024, 1, 15), dt.date(2024, 2, 14)),   # partial short -> 1
            (dt.date(2024, 1, 15), None)]
    df = spark.createDataFrame(rows, "s date, e date")
    assert [r[0] for r in df.select(term_months("s", "e")).collect()] == [3, 12, 2, 1, None]


def test_f9_overdue_days(spark):
    rows = [(None, None), (None, dt.date(2024, 1, 21)), (dt.date(2024, 1, 11), None),
            (dt.date(2024, 1, 1), dt.date(2024, 1, 21))]
    df = spark.createDataFrame(rows, "p date, i date")
    got = [r[0] for r in df.select(overdue_days(D, "p", "i")).collect()]
    assert got == [0, 11, 21, 31]


def test_f17_decode_null_and_unlisted(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,), ("Z",)], "c string")
    plain = [r[0] for r in df.select(decode("c", {"A": "1", "B": "2"})).collect()]
    with_null = [r[0] for r in df.select(decode("c", {"A": "1", None: "n"}, "d")).collect()]
    assert plain == ["1", "2", None, None]
    assert with_null == ["1", "d", "n", "d"]


def test_f3_concat_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(concat_null_as_empty("x", "y", "z")).first()[0] == "ac"
    # code concatenation keeps SQL's NULL propagation
    assert df.select(F.concat("x", "y")).first()[0] is None


def test_f14_in_code_set_three_valued(spark):
    df = spark.createDataFrame([("C3011",), ("C3",), (None,)], "c string")
    got = [r[0] for r in df.select(F.when(in_code_set("c", ["C3011", "C3012"]), "Y").otherwise("N")).collect()]
    assert got == ["Y", "N", "N"]


def test_text_after_and_rate_text(spark):
    df = spark.createDataFrame([("[x]tail", Decimal("3.14159")), ("plain]", Decimal("2.5")), ("none", None)],
                               "s string, r decimal(12,6)")
    got = df.select(text_after("s", "]"), rate_text("r")).collect()
    assert [tuple(r) for r in got] == [("tail", "3.14159"), (None, "2.50000"), ("none", None)]


def test_effective_rate_exact(spark):
    df = spark.createDataFrame([(Decimal("3.1"), Decimal("0.5"), Decimal("10"))], "b decimal(12,6), s decimal(12,6), a decimal(12,6)")
    assert df.select(effective_rate("b", "s", "a")).first()[0] == Decimal("3.960000")
    parts = spark.createDataFrame([(Decimal("3.1"), None, Decimal("10")), (None, Decimal(1), Decimal(1)), (Decimal(1), Decimal(1), None),
                                   (Decimal("3.12345678"), Decimal("0.00000001"), Decimal("33.333333"))],
                                  "b decimal(14,8), s decimal(14,8), a decimal(12,6)")
    assert [r[0] for r in parts.select(effective_rate("b", "s", "a")).collect()] == [
        None, None, None, Decimal("3.12345679") * Decimal("1.33333333")]
