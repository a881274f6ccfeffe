"""Statistics of sorted groups equal those of grouped aggregates, whatever the size of a group."""

import pytest
from pyspark.sql import functions as F

from loomfeat.operators import aggregate as agg
from loomfeat.operators import sorted_groups
from loomfeat.operators.quantiles import exact_quantiles

FNS = ["min", "max", "mean", "sum", "std", "median", "count", "size", "nunique", "nonzero", "skew", "kurt", "iqr"]


@pytest.fixture(scope="module")
def rows(spark):
    r = spark.range(3000).select(
        F.when(F.col("id") % 50 != 7, F.floor(F.pow(F.rand(1), 3) * 40).cast("int")).alias("k"),
        F.when(F.rand(3) < 0.8, F.round(F.randn(4) * 5)).alias("x"),
        F.randn(5).alias("y"),
        F.when(F.rand(9) < 0.9, (F.rand(10) * 3).cast("int")).alias("z"),
        (F.rand(6) * 4).cast("int").alias("c"),
    )
    return spark.createDataFrame(r.collect(), r.schema).repartition(5)


@pytest.mark.parametrize("group_rows", [sorted_groups.GROUP_ROWS, 200])
def test_wide_aggregate_equals_the_fused_one(rows, group_rows):
    parts = [agg.Part({"x": FNS, "z": FNS}, [agg.ALL, agg.eq_slice("one", "c", 1)]), agg.Part({"y": FNS}, [agg.Slice("up", F.col("x") > 0)], prefix="p_")]
    extra = [F.count_if(F.col("x").isNull()).alias("missing")]
    a, b = agg._aggregate_fused(rows, ["k"], parts, extra), agg.aggregate_parts(rows, "k", parts, extra, group_rows=group_rows)
    assert a.dtypes == b.dtypes
    want, got = ({r.k: r.asDict() for r in df.collect()} for df in (a, b))
    assert want.keys() == got.keys()
    for k, r in want.items():
        for c, v in r.items():
            assert got[k][c] == (pytest.approx(v, abs=1e-9) if isinstance(v, float) else v), (k, c)


def test_a_row_is_not_multiplied_by_its_quantiles(rows, spark):
    items = [(f"q{i}", F.col(c), w) for i, (c, w) in enumerate((c, w) for c in ("x", "y", "z") for w in (None, F.col("c") == 1, F.col("c") == 2))]
    plan = exact_quantiles(rows, ["k"], items, [0.5])._jdf.queryExecution().toString()
    assert "Generate explode" not in plan and "MapInArrow" in plan
