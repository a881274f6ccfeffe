"""Fused parts, checks inside plans, one-pass typing, staged scoring."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loomfeat.operators import aggregate as agg
from loomfeat.operators import columns as cols
from loomfeat.operators import joins, scoring, windows
from loomfeat.plans import blocks
from loomfeat.sources import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def test_parts_equal_their_aggregates(spark):
    o = fx.bureau(spark, SF_SMALL)
    opn = agg.eq_slice("opn", "o_orderstatus", "O")
    one = agg.Part({"o_totalprice": ["mean", "median", "iqr"], "o_orderpriority": ["nunique"]}, [agg.ALL, opn], prefix="a_")
    two = agg.Part({"o_totalprice": ["median", "sum"], "o_days": ["max"]}, [opn], prefix="b_")
    got = agg.aggregate_parts(o, "o_custkey", [one, two], [F.count(F.lit(1)).alias("n")])
    first = agg.aggregate(o, "o_custkey", one.spec, one.slices, prefix="a_")
    second = agg.aggregate(o, "o_custkey", two.spec, two.slices, prefix="b_", extra=[F.count(F.lit(1)).alias("n")])
    assert got.columns == [*first.columns, *second.columns[1:]]
    assert rows(got) == rows(first.join(second, "o_custkey"))


def test_a_block_reads_its_child_table_twice(spark):
    # once for all algebraic statistics of B5-B9, once for all medians
    df = blocks.bureau_part(blocks.bureau_rows(spark, SF_SMALL))
    df.collect()
    text = plan(df).split("Initial Plan")[0]
    assert text.count("FileScan parquet") == 2 and "ReusedExchange" in text
    assert "ObjectHashAggregate" not in text and "percentile" not in text


def test_last_k_has_no_percentile_buffers(spark):
    from loomfeat.plans.q_win import instalment_last_k

    text = plan(instalment_last_k(spark, SF_SMALL))
    assert "percentile" not in text and "WindowGroupLimit" in text


def test_last_k_arrays_equal_aggregates(spark):
    data = [(k, t, None if (k + t) % 7 == 0 and k else float((t * 37 + k) % 11) - 5) for k in range(4) for t in range(40 - 13 * k)] + [(9, 1, None), (8, 1, 2.0)]
    df = spark.createDataFrame(data, "k int, t int, x double").withColumn("i", F.col("x").cast("int"))
    fns = ["count", "size", "sum", "mean", "min", "max", "std", "var", "median", "iqr", "skew", "kurt", "nonzero"]
    got = windows.last_k(df, "k", ["t"], {"x": fns, "i": fns}, [1, 3, 12, 100], trend={5: ["x"]})
    ranked = windows.ranked(df, "k", ["t"])
    slices = [agg.Slice(str(k), F.col("__rn") <= k, f"__rn <= {k}") for k in (1, 3, 12, 100)]
    want = ranked.groupBy("k").agg(*agg.agg_exprs({"x": fns, "i": fns}, slices, namer=lambda p, c, t, f: f"last_{t}_{c}_{f}"))
    types = {f.name: f.dataType for f in want.schema.fields}
    assert {f.name: f.dataType for f in got.schema.fields if f.name in types} == types
    a, b = ({r["k"]: r.asDict() for r in x.collect()} for x in (got, want))
    for k in b:
        for c, v in b[k].items():
            assert (v is None) == (a[k][c] is None) or "skew" in c or "kurt" in c, (k, c, v, a[k][c])
            if v is not None and a[k][c] is not None:
                assert a[k][c] == pytest.approx(v, abs=1e-9), (k, c)


def test_repeated_key_fails_the_job_that_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    good = spark.createDataFrame([(1, 1.0), (3, 2.0)], "k int, w double")
    assert rows(joins.validated_left_join(left, good, "k")) == rows(left.join(good, "k", "left"))
    for a, b in ((left, good.union(good)), (left.union(left.where("k = 2")), good)):
        joined = joins.validated_left_join(a, b, "k")  # no job yet
        with pytest.raises(Exception, match="repeats"):
            joined.count()
        with pytest.raises(Exception, match="repeats"):
            joined.select("v").collect()


def test_few_distinct_is_exact(spark):
    data = [(i % 24, i % 25, i % 26, float(i % 2) * -1.0 if i % 3 else 0.0, None, i) for i in range(1000)]
    df = spark.createDataFrame(data, "a int, b int, c int, z double, e int, f long").repartition(7)
    assert cols.few_distinct(df, df.columns, 25) == {"a": 24, "b": None, "c": None, "z": 2, "e": 0, "f": None}
    assert cols.type_split(df)[1:] == (["a", "z", "e"], ["b", "c", "f"])
    assert cols.few_distinct(df.limit(0), ["a"], 25) == {"a": 0}


def test_narrowing_by_the_write_equals_a_pass(spark):
    df = spark.createDataFrame([(i, i * 1000, i * 10**10, i / 7, 1e300 * i, None) for i in range(100)], "a long, b long, c long, d double, e double, n int").repartition(5)
    a, b = cols.narrow_types(df, exclude=["c"]), cols.write_narrowed(df, "narrow", exclude=["c"])
    assert a.schema.simpleString() == b.schema.simpleString() and rows(a) == rows(b)
    assert [f.dataType.simpleString() for f in b.schema.fields] == ["tinyint", "int", "bigint", "float", "double", "int"]


def test_many_pivots_equal_single_ones(spark):
    o = fx.bureau(spark, SF_SMALL).withColumn("gap", F.when(F.col("o_orderkey") % 3 == 0, F.lit("x y")))
    wide = agg.category_counts_many(o, "o_custkey", ["o_orderstatus", "gap"], lambda c, v: f"{c}_{agg.sanitize(v)}")
    single = agg.category_counts(o, "o_custkey", "o_orderstatus", prefix="o_orderstatus_", absent_as_null=True)
    assert rows(wide.drop("gap_x_y")) == rows(single)
    with pytest.raises(ValueError):
        agg.category_counts_many(o, "o_custkey", ["o_orderkey"], lambda c, v: v, max_values=50)


def test_every_entity_has_a_row_of_numbers(spark):
    for block in (blocks.bureau_block, blocks.balance_block):
        out = block(spark, SF_SMALL, None)
        n, nulls = out.agg(F.count("*"), F.sum(sum(F.col(c).isNull().cast("int") for c in out.columns))).first()
        assert n == fx.application(spark, SF_SMALL).count() and nulls == 0


def test_best_round():
    assert scoring.best_round([0.5, 0.6, 0.55, 0.59, 0.7], 2) == 2
    assert scoring.best_round([0.5, 0.6, 0.55, 0.59, 0.7], 3) == 5
    assert scoring.best_round([None, None], 1) == 1


def test_margins_of_all_rounds_are_the_models(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = [(i, float(i % 13), float((i * 7) % 5), float((i % 13 > 6) ^ (i % 11 == 0))) for i in range(300)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="__features").transform(spark.createDataFrame(data, "id int, a double, b double, y double"))
    model = GBTClassifier(featuresCol="__features", labelCol="y", maxIter=5, maxDepth=3, seed=1).fit(df)
    whole = {r.id: r.p for r in model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    staged = scoring._staged(model, df).select("id", "__margins", scoring._probability(F.get("__margins", F.lit(4))).alias("p")).collect()
    assert all(len(r["__margins"]) == 5 and r.p == pytest.approx(whole[r.id]) for r in staged)


def test_scores_cover_every_row_and_stop_at_the_best_round(spark):
    data = [(i, float(i % 17), float(i % 3), float(i % 17 > 8) if i % 4 else None) for i in range(240)]
    df = spark.createDataFrame(data, "id long, a double, b double, y double")
    out = scoring.oof_scores(df, "id", "y", ["a", "b"], k=3, rounds=4, patience=2, metric="gini", max_depth=2)
    assert {r.id for r in out.oof.collect()} == {i for i in range(240) if i % 4} and {r.id for r in out.test.collect()} == set(range(0, 240, 4))
    assert sum(r.importance for r in out.importance.collect()) == pytest.approx(1.0)
    stages = out.stages.collect()
    assert len(stages) == 12 and sum(r.best for r in stages) == 3
