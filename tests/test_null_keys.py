"""Cases where a plan's choice must not change the result: NULL keys, tied values, small denominators."""

import random

import pytest
from pyspark.sql import functions as F

from loomfeat.operators import aggregate as agg
from loomfeat.operators import encode, joins, windows
from loomfeat.operators.quantiles import exact_quantiles


def rows_by_key(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 4.0), (None, 3.0), (1, 5.0), (1, None)], "k int, v double")
    got = rows_by_key(agg.aggregate(df, "k", {"v": ["median", "iqr", "nunique"]}))
    assert got[None] == (3.0, 1.0, 3)
    assert got[1][0] == 5.0 and got[1][2] == 1


def test_quantiles_of_tied_values_equal_percentile(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, 1, 2]), 0.0 if rng.random() < 0.9 else round(rng.uniform(-5, 5), 2)) for _ in range(2000)]
    df = spark.createDataFrame(data, "k int, v double").repartition(16)
    items = [("v", F.col("v"), None), ("w", F.col("v"), F.col("v") != 0)]
    got = rows_by_key(exact_quantiles(df, ["k"], items, [0.25, 0.5, 0.9]))
    want = rows_by_key(df.groupBy("k").agg(*[F.percentile(c, p) for c in (F.col("v"), F.when(F.col("v") != 0, F.col("v"))) for p in (0.25, 0.5, 0.9)]))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


def test_lag_by_rank_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), (7, 1, 3.0)], "k int, t int, v double")
    for method in ("window", "rank"):
        got = {(r.k, r.t): r.p for r in windows.lag_within(df, ["k"], ["t"], "v", "p", method=method).collect()}
        assert got == {(None, 1): None, (None, 2): 1.0, (7, 1): None}


def test_small_denominators_are_not_zero(spark):
    df = spark.createDataFrame([(5e-10, 1e-10), (1.0, 0.0)], "last_1_v_mean double, last_2_v_mean double")
    got = [r[0] for r in windows.fraction_features(df, [(1, 2)], {"v": ["mean"]}).select("last_1by2_fraction_v_mean").collect()]
    assert got == [pytest.approx(5.0), 0.0]


def test_encoders_have_no_category_limit(spark):
    n = 120_000
    df = spark.range(n).select(F.format_string("c%06d", "id").alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    df = df.union(spark.createDataFrame([(None, 1)], "c string, y int"))
    codes = encode.factorize(df, ["c"]).agg(F.min("c"), F.max("c"), F.count_distinct("c")).first()
    assert tuple(codes) == (-1, n - 1, n + 1)
    assert encode.woe_encode(df, ["c"], "y").where("c_woe = 0").count() == n + 1


def test_a_second_statistics_row_is_not_hidden(spark):
    two = spark.createDataFrame([(1,), (2,)], "s int")
    assert joins.attach_one_row(spark.range(3), two).count() == 6
