"""Date windows over text, as-of reads of many dates, long ordered lists and slices joined as they lie."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendgrid.functions import date_lit, date_texts, norm_date, text_date_between
from lendgrid.operators import collect_concat, ordered_concat
from lendgrid.plans.ledger import colocated_slices
from lendgrid.rundate import RunDate
from lendgrid.sources import as_of, as_of_dates, date_window

SMALL = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "null", "20240131", "2024-01-31", "2024/01/31", " 2024-01-31", "2024-01-31 23:59:59", "2024-01-31T10:00", "20240131 x", "20240201", "2024-02-01", "2024/02/01 00:00:00",
         "20231231", "2023-12-31 23:59", "2024-1-5", "20241301", "2024-02-30", "99991231", "9999-12-31", "00010101", "0001-01-01", "abc", "~", "  20240115 ", "!2024-01-31", "2024-01-15 日"]


def test_text_window_equals_the_exact_test(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    days = [None, dt.date.min, dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date.max]
    for low, high in itertools.product(days, days):
        exact = norm_date("t").isNotNull() & (F.lit(True) if low is None else norm_date("t") >= date_lit(low)) & (F.lit(True) if high is None else norm_date("t") <= date_lit(high))
        both = df.select(F.coalesce(text_date_between("t", low, high), F.lit(False)).alias("a"), F.coalesce(exact, F.lit(False)).alias("b"), "t").where("a <> b").collect()
        assert not both, (low, high, both)


@settings(max_examples=200, deadline=None)
@given(st.dates(), st.dates(), st.sampled_from(range(3)), st.sampled_from(["", " 12:00:00", "T1", " \x7f"]))
def test_every_layout_sorts_as_its_dates(day, bound, layout, behind):
    text = date_texts(day)[layout] + behind
    assert (text >= date_texts(bound)[layout]) == (day >= bound)


def scan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_bounds_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    spark.createDataFrame([(t, 1) for t in TEXTS], "t string, n int").write.parquet(f"{tmp_path}/t")
    plan = scan_of(date_window(spark.read.parquet(f"{tmp_path}/t"), "t", dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    for bound in ("20240101", "20240201", "2024-01-01", "2024-02-01", "2024/01/01", "2024/02/01"):
        assert bound in pushed, plan
    spark.createDataFrame([(dt.date(2024, 1, 5),)], "d date").write.parquet(f"{tmp_path}/d")
    assert "2024-01-01" in scan_of(date_window(spark.read.parquet(f"{tmp_path}/d"), "d", dt.date(2024, 1, 1), None)).split("PushedFilters")[1]


@pytest.fixture(scope="module")
def history(spark):
    r, rows = random.Random(4), []
    for key in range(60):
        day = dt.date(2023, 11, 1) + dt.timedelta(days=r.randrange(60))
        while day < dt.date(2024, 3, 1):
            end = day + dt.timedelta(days=r.choice([1, 3, 20, 70]))
            last = r.random() < 0.2
            rows.append((key, len(rows), day, dt.date(9999, 12, 31) if last else end, f"{day:%Y%m}"))
            if last:
                break
            day = end
    return spark.createDataFrame(rows, "key int, v int, begndt date, overdt date, partid string")


@pytest.mark.parametrize("part", ["partid", None])
def test_many_dates_in_one_read_equal_single_reads(spark, history, part):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)] + [dt.date(2023, 11, 30), dt.date(2024, 2, 29), dt.date(2024, 2, 29)]
    got = sorted(tuple(r) for r in as_of_dates(history, days, part=part).select("as_of_dt", "v").collect())
    want = sorted((d, r.v) for d in set(days) for r in as_of(history, RunDate(d), part=part).collect())
    assert got == want and len(want) > 100
    assert as_of_dates(history, [], part=part).count() == 0


def test_a_stored_history_reads_one_folder(spark, history, tmp_path):
    history.write.partitionBy("partid").parquet(f"{tmp_path}/h")
    stored = spark.read.schema(history.schema).parquet(f"{tmp_path}/h")
    one = as_of(stored, RunDate(dt.date(2024, 1, 15)))
    plan = scan_of(one)
    assert "202401" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "begndt" in plan.split("PushedFilters")[1]
    assert {f.split("partid=")[1][:6] for f in one.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"202401"}
    many = scan_of(as_of_dates(stored, [dt.date(2024, 1, 3), dt.date(2023, 12, 5)]))
    assert "202312" in many.split("PartitionFilters")[1] and "NestedLoop" not in many and "Cartesian" not in many


def test_ordered_list_of_a_million_values(spark):
    n = 1_000_000
    rows = spark.range(n, numPartitions=8).select(F.lit("hot").alias("k"), F.format_string("v%07d", (F.col("id") * 7919) % n).alias("v")).union(
        spark.createDataFrame([("cold", "b"), ("cold", "a"), ("cold", "a"), ("cold", None), (None, "z")], "k string, v string"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.k: (r.n, r.md5) for r in ordered_concat(rows, ["k"], "v", "|", "all").select("k", F.length("all").alias("n"), F.md5(F.col("all").cast("binary")).alias("md5")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    import hashlib

    def digest(values):
        text = "|".join(values)
        return len(text), hashlib.md5(text.encode()).hexdigest()

    assert got == {"hot": digest(f"v{i:07d}" for i in range(n)), "cold": digest(["a", "a", "b"]), None: digest(["z"])}


def test_ordered_concat_equals_collect_concat(spark):
    r = random.Random(9)
    rows = spark.createDataFrame([(r.randrange(5), "".join(r.choices("ab日", k=r.randint(0, 4)))) for _ in range(400)], "k int, v string")
    one, two = (sorted(tuple(x) for x in f(rows, ["k"], "v", ",", "l").collect()) for f in (ordered_concat, collect_concat))
    assert one == two


def test_stored_slices_are_joined_without_a_shuffle(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = colocated_slices(spark, SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and df.count() > 0
