"""Blocks on the spine: rows without a part are zeros, and take no part in the wide joins."""

from pyspark.sql import functions as F

from loomfeat.operators import columns as cols
from loomfeat.operators import joins
from loomfeat.plans import blocks


def test_rows_without_a_part_are_zeros_beside_the_joins(spark):
    spine = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k long")
    a = spark.createDataFrame([(1, 1.5, "x", 4), (2, None, None, None), (9, 2.0, "y", 1), (None, 7.0, "z", 2)], "k long, v double, s string, n int")
    b = spark.createDataFrame([(2, float("nan"), True)], "k long, w double, t boolean")
    before = cols.fill_zero(joins.join_chain(spine, [a, b], "k"))
    after = blocks.spine_join(spine, [a, b], "k", known=a)
    assert after.dtypes == before.dtypes
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect()))


def test_card_block_joins_only_entities_with_rows(spark, tmp_path, monkeypatch):
    rows = [(i, f"2024-01-{1 + i % 28:02d} 00:00:00", i % 3, "purchase", float(i), "{}") for i in range(12)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(50).selectExpr("id AS c_custkey", "1.0D AS c_acctbal").write.parquet(str(tmp_path / "customer.parquet"))
    joined = []
    real = joins.join_chain
    monkeypatch.setattr(joins, "join_chain", lambda spine, parts, on: joined.append(spine.count()) or real(spine, parts, on))
    block = blocks.card_block(spark, str(tmp_path), corr_threshold=None)
    assert joined == [3]  # 50 before
    assert block.select("sk_id_curr", "card_out_overdue_flag_count").where("card_out_overdue_flag_count = 0").count() == 47
