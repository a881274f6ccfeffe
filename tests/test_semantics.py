"""Null, NaN and edge-case rules on hand-made frames."""

import math

import pytest
from pyspark.sql import functions as F

from loomfeat.functions import aggfns
from loomfeat.functions import exprs as X
from loomfeat.operators import aggregate as agg
from loomfeat.operators import windows as win


def rows(df, order=None):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]


def test_n1_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 1.0)], "a double, b double")
    out = [r[0] for r in df.select(X.ratio("a", "b")).collect()]
    assert out == [None, None, 1.5, None]
    g = [r[0] for r in df.select(X.guarded_ratio("a", "b")).collect()]
    assert g == [1.0, 0.0, 1.0, None]


def test_n2_n3_slice_guards(spark):
    # key 1: rows in slice with only NULL values -> sum 0, count 0; key 2: no row in slice -> NULL
    df = spark.createDataFrame([(1, "A", None), (1, "B", 5.0), (2, "B", 1.0)], "k int, s string, x double")
    sl = agg.Slice("a", F.col("s") == "A")
    out = {r["k"]: r for r in rows(agg.aggregate(df, "k", {"x": ["sum", "count", "size", "mean"]}, [sl]))}
    assert out[1]["x_a_sum"] == 0 and out[1]["x_a_count"] == 0 and out[1]["x_a_size"] == 1
    assert out[2]["x_a_sum"] is None and out[2]["x_a_count"] is None and out[2]["x_a_size"] is None
    assert out[1]["x_a_mean"] is None


def test_n4_std_single_row_null(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 1.0), (2, 3.0)], "k int, x double")
    out = {r["k"]: r["x_std"] for r in rows(agg.aggregate(df, "k", {"x": ["std"]}))}
    assert out[1] is None and out[2] == pytest.approx(math.sqrt(2.0))


def test_n5_flag_of_null_is_zero(spark):
    df = spark.createDataFrame([(None,), (1.0,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(X.flag_gt("x", 0)).collect()] == [0, 1, 0]


def test_n6_nonzero_rate_counts_null_as_nonzero(spark):
    df = spark.createDataFrame([(1, 0.0), (1, None), (1, 2.0), (1, 0.0)], "k int, x double")
    out = rows(agg.aggregate(df, "k", {"x": ["nonzero"]}))[0]
    assert out["x_nonzero"] == pytest.approx(0.5)


def test_n7_null_category_dropped(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "b"), (2, "a")], "k int, c string")
    out = {r["k"]: r for r in rows(agg.category_counts(df, "k", "c", prefix="c_", absent_as_null=True))}
    assert set(out[1].keys()) == {"k", "c_a", "c_b"}
    assert out[1]["c_a"] == 1 and out[2]["c_b"] is None


def test_n9_moments_null_when_any_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, None), (2, 1.0), (2, 2.0), (2, 4.0)], "k int, x double")
    out = {r["k"]: r for r in rows(agg.aggregate(df, "k", {"x": ["skew", "kurt", "iqr"]}))}
    assert out[1]["x_skew"] is None and out[1]["x_kurt"] is None and out[1]["x_iqr"] is None
    assert out[2]["x_iqr"] == pytest.approx(1.5)
    # population skewness of (1, 2, 4)
    m = 7 / 3
    m2 = sum((v - m) ** 2 for v in (1, 2, 4)) / 3
    m3 = sum((v - m) ** 3 for v in (1, 2, 4)) / 3
    assert out[2]["x_skew"] == pytest.approx(m3 / m2 ** 1.5)


def test_constant_group_moments_null(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 3.0), (1, 3.0)], "k int, x double")
    out = rows(agg.aggregate(df, "k", {"x": ["skew", "kurt"]}))[0]
    assert out["x_skew"] is None and out["x_kurt"] is None


def test_shifted_moments_match_builtin(spark):
    import random

    rnd = random.Random(3)
    data = [(k, rnd.gauss(1000, 5) if rnd.random() > 0.2 else float(rnd.randint(990, 1010))) for k in range(20) for _ in range(30)]
    df = spark.createDataFrame(data, "k int, x double")
    ref = {r["k"]: r for r in rows(agg.aggregate(df, "k", {"x": ["skew", "kurt"]}))}
    w = win.last_k(df.withColumn("o", F.monotonically_increasing_id()), "k", ["o"], {"x": ["skew", "kurt"]}, [1000])
    got = {r["k"]: r for r in rows(w)}
    for k in ref:
        assert got[k]["last_1000_x_skew"] == pytest.approx(ref[k]["x_skew"], rel=1e-6, abs=1e-9)
        assert got[k]["last_1000_x_kurt"] == pytest.approx(ref[k]["x_kurt"], rel=1e-6, abs=1e-9)


def test_n12_trend(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0), (2, 1, 1.0), (2, 2, 3.0), (2, 3, 5.0), (3, 1, None), (3, 2, 1.0)], "k int, t int, y double"
    )
    out = {r["k"]: r for r in rows(win.last_k(df, "k", ["t"], {}, [], trend={10: ["y"]}))}
    assert out[1]["trend_10_y"] == 0.0  # single row
    # newest first: x = 0 for t=3 -> y decreases by 2 per step back
    assert out[2]["trend_10_y"] == pytest.approx(-2.0)
    assert out[3]["trend_10_y"] is None  # a missing y


def test_n13_first_valid(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (1, 3, None)], "k int, o int, x double")
    out = df.groupBy("k").agg(aggfns.agg_first_valid(F.col("o"))(F.col("x")).alias("v")).first()
    assert out["v"] == 2.0


def test_n14_row_wise(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (2.0, 4.0, 9.0)], "a double, b double, c double")
    cols = ["a", "b", "c"]
    out = df.select(
        X.row_min(cols).alias("mn"), X.row_max(cols).alias("mx"), X.row_sum(cols).alias("s"),
        X.row_mean(cols).alias("m"), X.row_median(cols).alias("md"), X.row_std(cols).alias("sd"),
        X.row_null_count(cols).alias("nc"),
    ).collect()
    assert (out[0]["mn"], out[0]["mx"], out[0]["s"], out[0]["m"], out[0]["md"]) == (1.0, 3.0, 4.0, 2.0, 2.0)
    assert out[0]["sd"] == pytest.approx(math.sqrt(2.0)) and out[0]["nc"] == 1
    assert out[1]["mn"] is None and out[1]["s"] == 0.0 and out[1]["m"] is None and out[1]["md"] is None
    assert out[2]["md"] == 4.0


def test_sentinels(spark):
    df = spark.createDataFrame([(365243.0,), (-50000.0,), (5.0,)], "x double")
    out = df.select(X.null_if_equal("x", 365243).alias("a"), X.null_if("x", F.col("x") < -40000).alias("b")).collect()
    assert [r["a"] for r in out] == [None, -50000.0, 5.0]
    assert [r["b"] for r in out] == [365243.0, None, 5.0]


def test_w8_fraction_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (1.0, 4.0), (1.0, None)], "last_5_x_sum double, last_20_x_sum double")
    out = win.fraction_features(df, [(5, 20)], {"x": ["sum"]}).collect()
    assert [r["last_5by20_fraction_x_sum"] for r in out] == [0.0, None, 0.25, None]


def test_value_map(spark):
    df = spark.createDataFrame([(0,), (2,), (3,)], "n int")
    out = [r[0] for r in df.select(X.value_map("n", {0: 0.5, 2: 0.9})).collect()]
    assert out == [0.5, 0.9, None]
