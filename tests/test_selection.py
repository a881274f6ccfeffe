"""Exact cuts and samples by hash order: counts, repeatability, ties, empty tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from loomfeat.operators import scoring, selection
from loomfeat.sources import io


def order(rows, seed):
    return sorted(rows, key=lambda r: (hashlib.md5(f"{seed}|{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, str(r[1])))


@pytest.mark.parametrize("small", [1, 20, 100_000])
@pytest.mark.parametrize("n", [0, 1, 37, 250, 299, 300, 900])
def test_smallest_is_the_hash_order(spark, n, small):
    rows = [(i if i % 50 else None, f"v{i}") for i in range(200)] + [(7, f"copy{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "k long, v string").repartition(3)
    got = selection.smallest(df, "k", n, seed=5, small=small).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, order(rows, 5)[:n]))


def test_split_is_exact_and_whole(spark):
    for n in (0, 1, 5, 10, 399):
        df = spark.range(n).withColumn("x", F.col("id") * 2)
        out = scoring.split_flag(df, "id").collect()
        assert len(out) == n and sum(r.is_train for r in out) == round(n * 0.9)
    same = spark.createDataFrame([(1, "a")] * 40, "k int, v string")
    assert scoring.split_flag(same, "k", 0.25).agg(F.sum("is_train")).first()[0] == 10


def test_folds_have_equal_sizes(spark):
    sizes = scoring.kfold(spark.range(103), "id", 5).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in sizes) == [20, 20, 21, 21, 21]
    assert io.exact_sample(spark.range(1000), 123, "id").count() == 123
