"""Physical-plan properties the scale design relies on."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from loomfeat.operators import aggregate as agg
from loomfeat.plans import catalog
from loomfeat.session import shuffle_partitions_for
from loomfeat.sources import fixtures as fx
from loomfeat.sources import io


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fused_slices_shuffle_the_child_table_once(spark):
    text = plan(catalog.order_activity(spark, SF_SMALL))
    # all 9 slices x 9 statistics come from one partial + final aggregate on the entity key
    assert text.count("Exchange hashpartitioning(o_custkey") == 1
    naive = plan(catalog.order_activity(spark, SF_SMALL, fused=False))
    assert naive.count("HashAggregate") > text.count("HashAggregate")


def test_nunique_has_no_expand(spark):
    o = fx.bureau(spark, SF_SMALL)
    slices = [agg.ALL, agg.eq_slice("opn", "o_orderstatus", "O"), agg.eq_slice("fin", "o_orderstatus", "F")]
    out = agg.aggregate(o, "o_custkey", {"o_orderpriority": ["nunique"], "o_totalprice": ["mean"]}, slices)
    assert "Expand" not in plan(out)


def test_projection_and_filter_reach_the_scan(spark):
    path = f"{SF_SMALL}/lineitem.parquet"
    li = io.read_table(spark, path, where=F.col("l_extendedprice") > 1000)
    q = io.projected(li, ["l_orderkey", "l_extendedprice"])
    text = plan(q)
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text
    assert "GreaterThan(l_extendedprice,1000" in text
    # same rows as filtering the scrubbed table
    ref = io.projected(io.read_table(spark, path), ["l_orderkey", "l_extendedprice"]).where(F.col("l_extendedprice") > 1000)
    assert q.count() == ref.count()


def test_nan_rows_filtered_like_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 5000.0), (3, 10.0)], "k int, x double")
    path = str(tmp_path / "nan.parquet")
    df.write.parquet(path)
    got = sorted(r["k"] for r in io.read_table(spark, path, where=F.col("x") > 1000).collect())
    assert got == [2]


def test_non_float_filters_push_through_the_scrub(spark):
    li = fx.table(spark, SF_SMALL, "lineitem")
    q = io.projected(li, ["l_orderkey", "l_shipdate"]).where(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    assert "GreaterThanOrEqual(l_shipdate" in plan(q)


def test_shuffle_partition_sizing():
    assert shuffle_partitions_for(100 * 2**40) == 409600
    assert shuffle_partitions_for(10**6) == 200
