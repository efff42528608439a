import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendgrid.operators import (
    code_map, collect_concat, exists_flag, first_flag, having_multi, latest_by, lookup_unique,
    membership_flag, top1_by_max,
)


def test_f4_latest_by_tiebreak_and_null_key(spark):
    rows = [("A", 2, "x"), ("A", 2, "y"), ("A", 1, "z"), (None, 5, "n1"), (None, 4, "n2")]
    df = spark.createDataFrame(rows, "k string, o int, t string")
    got = latest_by(df, ["k"], [F.col("o").desc(), F.col("t").desc()]).collect()
    assert {(r.k, r.t) for r in got} == {("A", "y"), (None, "n1")}


def test_top1_by_max_keeps_ties(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, 2), (2, 1)], "k int, p int")
    assert top1_by_max(df, ["k"], "p").count() == 3


def test_f18_lookup_unique_zero_one_many(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(2, "b"), (3, "c1"), (3, "c2")], "k int, v string")
    ok = lookup_unique(left.where("k < 3"), right, ["k"], ["v"]).orderBy("k").collect()
    assert [(r.k, r.v) for r in ok] == [(1, None), (2, "b")]
    with pytest.raises(Exception) as e:
        lookup_unique(left, right, ["k"], ["v"]).collect()
    assert "more than one row" in str(e.value)


def test_f5_fan_out_non_strict_doubles(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert left.join(right, "k", "left").count() == 2  # the reference's behaviour
    assert lookup_unique(left, right, ["k"], ["v"], strict=False).count() == 2
    with pytest.raises(Exception):
        lookup_unique(left, right, ["k"], ["v"]).collect()


def test_f7_code_map(spark):
    codes = spark.createDataFrame([("D", "A", "alpha"), ("D", "B%", "beta"), ("X", "A", "other")],
                                  "dict_code string, ori_values string, new_values string")
    codes = codes.withColumn("ori_values", F.replace("ori_values", F.lit("%"), F.lit("")))
    df = spark.createDataFrame([("A",), ("B",), ("Q",), (None,)], "c string")
    got = code_map(df, "c", codes, "D", "m", default=F.lit("dflt")).collect()
    assert sorted((r.c or "", r.m) for r in got) == [("", "dflt"), ("A", "alpha"), ("B", "beta"), ("Q", "dflt")]


def test_f11_first_loan_flag_ties_on_date(spark):
    d = dt.date(2024, 1, 1)
    rows = [("c1", "L2", "CL_1", d), ("c1", "L1", "PL_2", d), ("c1", "L0", "XL_6", dt.date(2024, 2, 1)),
            ("c2", "L9", "NL_3", d)]
    df = spark.createDataFrame(rows, "cust_id string, loan_num string, src string, drawdown_dt date")
    got = first_flag(df, ["cust_id"], ["drawdown_dt", "loan_num"], ["loan_num", "src"], "f").collect()
    flags = {r.loan_num: r.f for r in got}
    assert flags == {"L1": "Y", "L2": "N", "L0": "N", "L9": "Y"}


def test_f16_collect_concat_sorted_across_chunks(spark):
    vals = ["1500", "20", "100000000000000099", "3", "15", "2"]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", None)], "k string, v string")
    rewritten = F.when(F.substring("v", 1, 1) == "1", F.concat(F.substring("v", 1, 14), F.lit("1"))).otherwise(F.col("v"))
    got = {r.k: r.s for r in collect_concat(df, ["k"], rewritten, "|", "s", chunk_prefix=1).collect()}
    expect = sorted([v[:14] + "1" if v.startswith("1") else v for v in vals])
    assert got == {"a": "|".join(expect)}


def test_f2_not_equal_drops_null(spark):
    df = spark.createDataFrame([("NORM",), ("CHRGO",), (None,)], "s string")
    assert df.where(F.col("s") != "CHRGO").count() == 1


def test_flags(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    ids = spark.createDataFrame([(2,), (2,), (None,)], "id int")
    got = {r.k: r.f for r in exists_flag(df, "k", ids, "id", "f").collect()}
    assert got == {1: "N", 2: "Y", 3: "N", None: "N"}
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(3,)], "y int")
    got = {r.k: r.f for r in membership_flag(df, "k", [a, b], "f").collect()}
    assert got == {1: "Y", 2: "N", 3: "Y", None: "N"}
    g = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [r.k for r in having_multi(g, ["k"]).collect()] == ["a"]


def test_first_last_aggs_match_row_number(spark):
    from pyspark.sql import Window

    from lendgrid.operators import first_last_aggs
    rows = [("a", 1, "x", "p1"), ("a", None, "y", "p2"), ("a", 3, None, "p3"), ("a", 3, "b", "p4"),
            ("b", None, None, "q1"), ("b", None, "z", "q2"), ("c", 2, "k", "r1")]
    df = spark.createDataFrame(rows, "k string, o1 int, o2 string, v string")
    agg = df.groupBy("k").agg(*first_last_aggs(["o1", "o2"], ["v"]))
    got = {r.k: (r.first.v, r.last.v) for r in agg.collect()}
    asc = Window.partitionBy("k").orderBy(F.col("o1").asc_nulls_last(), F.col("o2").asc_nulls_last())
    desc = Window.partitionBy("k").orderBy(F.col("o1").desc_nulls_last(), F.col("o2").desc_nulls_last())
    ranked = df.withColumn("ra", F.row_number().over(asc)).withColumn("rd", F.row_number().over(desc))
    first = {r.k: r.v for r in ranked.where("ra = 1").collect()}
    last = {r.k: r.v for r in ranked.where("rd = 1").collect()}
    assert got == {k: (first[k], last[k]) for k in first}


def test_first_flag_null_group_and_row_key_match(spark):
    d1 = dt.date(2024, 1, 1)
    rows = [(None, "L1", "A", d1), (None, "L2", "A", dt.date(2024, 2, 1)), ("c", "L3", "B", d1),
            ("c", "L3", "B", d1)]
    df = spark.createDataFrame(rows, "cust string, loan string, src string, d date")
    grouped = first_flag(df, ["cust"], ["d", "loan"], ["loan", "src"], "f").collect()
    # NULL customers form one group (like PARTITION BY); duplicated rows of a first key all match
    assert sorted((r.loan, r.f) for r in grouped) == [("L1", "Y"), ("L2", "N"), ("L3", "Y"), ("L3", "Y")]
    by_key = first_flag(df, ["cust"], ["d", "loan"], ["loan", "src"], "f", match_group=False).collect()
    assert sorted((r.loan, r.f) for r in by_key) == [("L1", "Y"), ("L2", "N"), ("L3", "Y"), ("L3", "Y")]
