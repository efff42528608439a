"""Look-ups attached together, and left joins split by key, against plain left joins."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendgrid.operators import Lookup, attach_many, split_left_join
from lendgrid.operators.skew import heavy_keys


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def frames(spark, seed=3):
    r = random.Random(seed)
    some = lambda values: r.choice([None, *values])
    driving = spark.createDataFrame([(i % 50, some("abc"), some("abcd"), some(range(5)), f"row {i % 45}") for i in range(80)], "id long, a string, b string, n int, text string")
    x = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 9), ("z", 5)], "x_key string, x int")  # b is there twice
    y = spark.createDataFrame([("a", "A"), ("d", "D"), ("d", None)], "y_key string, y string")
    z = spark.createDataFrame([("a", 1, "za1"), ("c", 4, "zc4"), ("c", None, "no"), (None, 1, "no")], "z_key string, z_n int, z string")
    u = spark.createDataFrame([(i, i * 1.5) for i in range(0, 60, 2)], "u_key long, u double")
    return driving, x, y, z, u


def test_attach_many_equals_left_joins(spark):
    driving, x, y, z, u = frames(spark)
    got = attach_many(driving, [Lookup(x, ["x_key"], ["a"]), Lookup(y, ["y_key"], [F.col("b")]), Lookup(z, ["z_key", "z_n"], ["b", "n"]), Lookup(u, ["u_key"], ["id"], unique=True),
                                Lookup(x.select(F.col("x_key").alias("w_key"), F.col("x").alias("w")), ["w_key"], [F.when(F.col("n") > 2, F.col("b"))])])
    want = (driving.join(x, driving.a == x.x_key, "left").join(y, driving.b == y.y_key, "left").join(z, (driving.b == z.z_key) & (driving.n == z.z_n), "left")
            .join(u, driving.id == u.u_key, "left").join(x.select(F.col("x_key").alias("w_key"), F.col("x").alias("w")), (F.col("n") > 2) & (F.col("b") == F.col("w_key")), "left"))
    assert got.columns == want.columns and rows(got) == rows(want)
    again = attach_many(driving, [Lookup(x, ["x_key"], ["a"])], row_key=["id", "text"])
    assert rows(again) == rows(driving.join(x, driving.a == x.x_key, "left"))


def test_written_driving_rows_equal_left_joins_in_fewer_shuffles(spark):
    driving, x, y, z, u = frames(spark)
    driving = driving.union(driving.limit(9)).withColumns({"nothing": F.lit(None), "half": F.col("n") / 2})
    h = spark.createDataFrame([(0.5, "x"), (1.0, "y"), (1.0, None)], "h_key double, h string")
    lookups = [Lookup(x, ["x_key"], ["a"]), Lookup(y, ["y_key"], [F.col("b")]), Lookup(z, ["z_key", "z_n"], ["b", "n"]), Lookup(u, ["u_key"], ["id"], unique=True),
               Lookup(h, ["h_key"], ["half"]), Lookup(x.select(F.col("x_key").alias("only")), ["only"], ["b"])]
    want = (driving.join(x, driving.a == x.x_key, "left").join(y, driving.b == y.y_key, "left").join(z, (driving.b == z.z_key) & (driving.n == z.z_n), "left")
            .join(u, driving.id == u.u_key, "left").join(h, F.col("half") == F.col("h_key"), "left").join(x.select(F.col("x_key").alias("only")), F.col("b") == F.col("only"), "left"))
    got = attach_many(driving, lookups, materialize=True)
    assert got.columns == want.columns and got.dtypes == want.dtypes and rows(got) == rows(want)


    class Held:
        def __init__(self):
            self.queryExecution = attach_many(driving, lookups, materialize=True)._jdf.queryExecution()

    assert exchanges(spark, Held) <= 4


def test_the_first_level_of_the_query_is_written_once(spark, capsys):
    from lendgrid.plans import QUERIES

    QUERIES["attach_many"](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "attach-" in plan and "lineitem" not in plan  # else it is computed twice, for its questions and for the join


def test_attach_many_edges(spark):
    driving, x, y, z, u = frames(spark)
    assert attach_many(driving.where("id < 0"), [Lookup(x, ["x_key"], ["a"])]).count() == 0
    alone = attach_many(driving.withColumn("a", F.lit(None).cast("string")), [Lookup(x, ["x_key"], ["a"])])
    assert alone.count() == 80 and alone.where("x is not null").count() == 0
    empty = attach_many(driving, [Lookup(x.where("x > 99"), ["x_key"], ["a"]), Lookup(y, ["y_key"], ["b"])])
    assert rows(empty) == rows(driving.withColumns({"x_key": F.lit(None).cast("string"), "x": F.lit(None).cast("int")}).join(y, F.col("b") == F.col("y_key"), "left"))
    with pytest.raises(TypeError, match="cast one"):
        attach_many(driving, [Lookup(u, ["u_key"], ["n"])])
    with pytest.raises(ValueError, match="twice"):
        attach_many(driving, [Lookup(x, ["x_key"], ["a"]), Lookup(x, ["x_key"], ["b"])])


def test_duplicate_keys_are_observed(spark):
    driving, x, y, z, u = frames(spark)
    checks = []
    got = attach_many(driving, [Lookup(x, ["x_key"], ["a"]), Lookup(y, ["y_key"], ["b"]), Lookup(u, ["u_key"], ["id"], unique=True)], checks=checks)
    n = got.count()
    assert n > 80 and checks[0].duplicates() == {"x_key": driving.where("a = 'b'").count(), "y_key": driving.where("b = 'd'").count()}
    for rows_of in (driving.where("id < 0"), driving.withColumn("a", F.lit(None).cast("string"))):  # nothing asked, nothing met
        checks.clear()
        attach_many(rows_of, [Lookup(x.where("x > 99"), ["x_key"], ["a"]), Lookup(y.where("y = '?'"), ["y_key"], ["b"])], checks=checks).collect()
        assert checks[0].duplicates() == {}


def exchanges(spark, df):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        return df().queryExecution.toString().split("== Physical Plan ==")[1].count("Exchange hashpartitioning")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_the_number_of_shuffles_does_not_grow_with_the_look_ups(spark):
    driving, x, _, _, _ = frames(spark)

    def plan(n):
        named = [x.select(F.col("x_key").alias(f"k{i}"), F.col("x").alias(f"v{i}")) for i in range(n)]
        return attach_many(driving, [Lookup(f, [f"k{i}"], ["a" if i % 2 else "b"]) for i, f in enumerate(named)])._jdf

    class Held:
        def __init__(self, n):
            self.queryExecution = plan(n).queryExecution()

    counts = [exchanges(spark, lambda n=n: Held(n)) for n in (2, 8)]
    assert counts[0] == counts[1] <= 5


def skewed(spark, n=30_000):
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7).cast("long")).otherwise(F.col("id") % 5000)
    return spark.range(n, numPartitions=6).select(F.col("id").alias("row"), key.alias("k"))


def test_split_left_join_equals_the_plain_one_and_spreads(spark):
    left = skewed(spark)
    right = spark.range(0, 6000, 2).select(F.col("id").alias("r_k"), F.concat(F.lit("v"), F.col("id")).alias("v")).union(spark.createDataFrame([(7, "a"), (7, "b"), (None, "n")], "r_k long, v string"))
    plain = rows(left.join(right, left.k == right.r_k, "left"))
    parts = split_left_join(left, right, {"k": "r_k"})
    assert len(parts.heavy_keys) == 1 and rows(parts.whole()) == plain
    assert parts.without_key.count() == 10_000 and parts.heavy.count() == 2 * left.where("k = 7").count()  # 7 is there twice
    # The shuffled part has neither the NULL key nor the heavy one: no task over three times the median.
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes = sorted(r["count"] for r in parts.rest.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # A heavy key with more right rows than may be broadcast stays in the shuffle.
    few = split_left_join(left, right, {"k": "r_k"}, most_broadcast=1)
    assert few.heavy_keys == () and rows(few.whole()) == plain


def test_split_left_join_of_two_columns_and_of_nothing(spark):
    left = skewed(spark, 900).withColumn("s", F.when(F.col("row") % 7 > 0, F.lit("x")))
    right = spark.createDataFrame([(7, "x", 1), (7, "y", 2), (8, "x", 3), (None, "x", 4), (7, None, 5)], "r_k long, r_s string, v int")
    want = rows(left.join(right, (left.k == right.r_k) & (left.s == right.r_s), "left"))
    assert rows(split_left_join(left, right, {"k": "r_k", "s": "r_s"}).whole()) == want
    assert split_left_join(left.where("row < 0"), right, {"k": "r_k"}).whole().count() == 0
    assert rows(split_left_join(left.where("k is null"), right, {"k": "r_k"}).whole()) == rows(left.where("k is null").join(right, F.col("k") == F.col("r_k"), "left"))
    assert heavy_keys(F.col("k"), left.where("k is null")) == {}
