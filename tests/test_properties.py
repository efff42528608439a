"""Property-based checks (hypothesis) of the history derivation and as-of read."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lendgrid.rundate import RunDate
from lendgrid.sources import as_of, history_from_events

BASE = dt.datetime(2024, 1, 1)

events = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 30 * 24 * 60)),  # key, minute offset in January
    min_size=1, max_size=40, unique=True)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.integers(1, 31))
def test_as_of_returns_the_last_change_on_or_before_the_day(spark, evs, day):
    rows = [(k, BASE + dt.timedelta(minutes=m), i, f"v{i}") for i, (k, m) in enumerate(evs)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, eid int, v string")
    hist = history_from_events(df, "k", "ts", "eid", ["v"])
    run = RunDate(dt.date(2024, 1, day))
    got = {r.k: r.v for r in as_of(hist, run).collect()}
    # brute force: per key, the last change (by time, then id) on or before the day
    expect = {}
    for k, ts, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        if ts.date() <= run.d:
            expect[k] = v
    assert got == expect
    # at most one active row per key
    assert as_of(hist, run).groupBy("k").count().where("count > 1").count() == 0


texts = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                           st.text(alphabet="019Zaé中", min_size=0, max_size=5)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts, st.integers(1, 3))
def test_collect_concat_equals_sorted_join(spark, rows, prefix):
    from lendgrid.operators import collect_concat
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r.k: r.s for r in collect_concat(df, ["k"], "v", "|", "s", chunk_prefix=prefix).collect()}
    expect = {}
    for k in {k for k, _ in rows}:
        # binary (code point) order, as Spark and the SQL oracle sort strings
        expect[k] = "|".join(sorted((v for kk, v in rows if kk == k), key=lambda x: x.encode("utf-8")))
    assert got == expect


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 5), min_size=1, max_size=12), st.lists(st.integers(0, 5), max_size=8))
def test_lookup_unique_raises_exactly_on_duplicates(spark, left_keys, right_keys):
    import pytest

    from lendgrid.operators import lookup_unique
    left = spark.createDataFrame([(k,) for k in left_keys], "k int")
    right = spark.createDataFrame([(k, f"v{k}") for k in right_keys], "k int, v string")
    dup = {k for k in right_keys if right_keys.count(k) > 1} & set(left_keys)
    if dup:
        with pytest.raises(Exception):
            lookup_unique(left, right, ["k"], ["v"]).collect()
    else:
        got = sorted((r.k, r.v) for r in lookup_unique(left, right, ["k"], ["v"]).collect())
        assert got == sorted((k, f"v{k}" if k in right_keys else None) for k in left_keys)


flag_rows = st.lists(st.tuples(st.sampled_from(["c1", "c2", None]), st.integers(0, 3), st.integers(0, 50)),
                     min_size=1, max_size=30, unique_by=lambda r: r[2])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(flag_rows)
def test_first_flag_equals_row_number(spark, rows):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from lendgrid.operators import first_flag
    df = spark.createDataFrame(rows, "cust string, d int, loan int")
    got = {r.loan: r.f for r in first_flag(df, ["cust"], ["d", "loan"], ["loan"], "f").collect()}
    w = Window.partitionBy("cust").orderBy(F.col("d").asc_nulls_last(), F.col("loan").asc_nulls_last())
    expect = {r.loan: ("Y" if r.rn == 1 else "N") for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == expect


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2099, 12, 31)), min_size=1, max_size=10),
       st.lists(st.text(alphabet="0123456789/-ab ", max_size=10), max_size=10))
def test_norm_date_layouts_and_junk(spark, days, junk):
    from lendgrid.functions import norm_date
    texts = []
    for d in days:
        texts += [d.strftime("%Y%m%d"), d.isoformat(), d.strftime("%Y/%m/%d")]
    df = spark.createDataFrame([(t,) for t in texts + junk], "s string")
    got = [r[0] for r in df.select(norm_date("s")).collect()]
    assert got[:len(texts)] == [d for d in days for _ in range(3)]
    for text, value in zip(junk, got[len(texts):]):
        if value is not None:   # junk only parses when it is a real date in a known layout
            digits = text.strip().replace("/", "").replace("-", "")
            assert value.strftime("%Y%m%d") == digits[:8] or value.isoformat() in text


seg_rows = st.lists(st.tuples(st.integers(0, 9), st.integers(-5, 5), st.sampled_from(["x", "y", None])),
                    min_size=1, max_size=25)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seg_rows, st.integers(-5, 5))
def test_split_segments_equals_union_of_filtered_projections(spark, rows, cut):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from lendgrid.operators.ledger import split_segments, union_segments
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("loan_num", T.StringType()), ("od_days", T.IntegerType()), ("acct_sts", T.StringType()),
        ("od_flg", T.StringType()), ("date_sourcesd", T.StringType()), ("data_date", T.StringType())]])
    base = spark.createDataFrame(rows, "id int, v int, s string")
    # overlapping predicates: the first matching segment takes the row
    specs = [("A", F.col("v") < cut, {"loan_num": F.col("id").cast("string"), "od_days": F.col("v")}),
             ("B", F.col("s") == "x", {"loan_num": F.col("id").cast("string"), "acct_sts": F.col("s")}),
             ("C", F.col("v") >= 0, {"loan_num": F.col("id").cast("string"), "od_flg": F.lit("Y")})]
    one_pass = split_segments(base, specs, "20240131", schema)
    taken = F.lit(False)
    frames = {}
    for tag, pred, cols in specs:
        # a NULL predicate does not match (as in CASE WHEN)
        frames[tag] = base.where(pred & ~taken).select(*[c.alias(n) for n, c in cols.items()])
        taken = taken | F.coalesce(pred, F.lit(False))
    unioned = union_segments(frames, "20240131", schema)
    assert one_pass.exceptAll(unioned).count() == 0 and unioned.exceptAll(one_pass).count() == 0
