"""The instalment block joins line items with their orders once and keeps only its parts."""

import os

import pytest
from pyspark.sql import functions as F

from loomfeat import session
from loomfeat.operators import windows as win
from loomfeat.plans import blocks
from loomfeat.plans import q_win as W
from loomfeat.sources import fixtures as fx


def tables(spark):
    folder = session.ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.fixture
def data(spark, tmp_path):
    day = "CAST('1996-01-01' AS TIMESTAMP_NTZ) + make_interval(0, 0, 0, CAST({} AS INT))"
    spark.range(12).selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "CAST(id % 5 AS INT) AS c_nationkey", "id * 10.5D - 20 AS c_acctbal", "'A' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(40).selectExpr("id AS o_orderkey", "id % 10 AS o_custkey", "'O' AS o_orderstatus", "id * 3.5D AS o_totalprice", day.format("id * 17") + " AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(300).selectExpr(
        "id % 43 AS l_orderkey", "id AS l_partkey", "id % 3 AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber", "CAST(id % 9 AS DOUBLE) AS l_quantity", "id * 1.25D AS l_extendedprice",
        "(id % 11) / 100D AS l_discount", "(id % 9) / 100D AS l_tax", "'R' AS l_returnflag", "'O' AS l_linestatus", day.format("id * 19 % 700") + " AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_no_pass_of_the_block_joins_the_tables_again(spark, data, monkeypatch):
    sources, before = [], tables(spark)
    write = session.written
    monkeypatch.setattr(blocks, "written", lambda df, name, *how: sources.append((name, df.inputFiles())) or write(df, name, *how))
    out = blocks.instalment_block(spark, data, None)
    assert [n for n, _ in sources] == ["instalment-basic", "instalment-prolongation", "instalment-last-k"]
    assert not any("lineitem" in f for _, files in sources for f in files)
    new = {t.rsplit("-", 1)[0] for t in tables(spark) - before}
    assert new >= {"instalment-basic", "instalment-prolongation", "instalment-last-k"} and not new & {"instalment-rows", "instalment-pay"}
    rows = W.instalment_rows(spark, data)
    want = {r["o_custkey"]: r for r in rows.groupBy("o_custkey").agg(F.sum("late_days").alias("late"), F.sum("paid_over").alias("over"), F.max("i_paid").alias("paid")).collect()}
    got = {r["c_custkey"]: r for r in out.collect()}
    assert len(got) == 12 and len(want) == 10
    for k, r in got.items():
        w = want.get(k)
        assert (r["late_days_sum"], r["paid_over_sum"]) == ((w["late"], w["over"]) if w else (0, 0))
        assert r["ins_i_paid_max"] == pytest.approx(w["paid"] if w else 0)


def test_held_rows_go_when_a_pass_fails(spark):
    before = tables(spark)
    with pytest.raises(RuntimeError):
        with session.held(spark.range(5), "held-rows") as rows:
            assert rows.count() == 5 and any(t.startswith("held-rows") for t in tables(spark) - before)
            raise RuntimeError
    assert not any(t.startswith("held-rows") for t in tables(spark) - before)


def test_last_k_derives_columns_after_its_shuffle(spark, data):
    i = fx.installments(spark, data)
    spec = {"late_days": ["sum", "median"], "paid_over": ["mean"]}
    for ks in ([1, 5], [3, None]):
        a = win.last_k(i, "o_custkey", ["i_days_due"], spec, ks, tiebreak=W.INS_ORDER_TIEBREAK, trend={4: ["over_amount"]}, derive=W.instalment_features)
        b = win.last_k(W.instalment_features(i), "o_custkey", ["i_days_due"], spec, ks, tiebreak=W.INS_ORDER_TIEBREAK, trend={4: ["over_amount"]})
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
