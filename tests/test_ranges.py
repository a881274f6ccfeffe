"""Ranges and counts of wide tables: one pass of Arrow batches, by Spark's rules."""

import math
from decimal import Decimal

from pyspark.sql import functions as F

from loomfeat.operators import columns as cols
from loomfeat.plans import kernel

NAN, INF = float("nan"), float("inf")


def test_ranges_are_those_of_an_aggregate(spark):
    data = [
        (i, None if i % 3 else 2**53 + i, NAN if i == 7 else i / 3 - 2, NAN, -INF if i == 2 else None, float(i), Decimal(i) / 4, "x" if i % 2 else None, i % 2 == 0, None)
        for i in range(20)
    ]
    df = spark.createDataFrame(data, "a long, b long, c double, d double, e double, `f g` float, h decimal(10,2), s string, t boolean, u int").repartition(4)
    found = cols.value_ranges(df)
    for f in df.schema.fields:
        q = F.col(f"`{f.name}`")
        n, low, high = df.agg(F.count(q), F.min(q), F.max(q)).first()
        assert found[f.name][0] == n
        if f.name in ("s", "t"):
            assert found[f.name][1:] == (None, None)
        else:
            same = lambda x, y: x == y or (x is not None and y is not None and math.isnan(x) and math.isnan(y))
            assert same(found[f.name][1], low) and same(found[f.name][2], high), f.name
    assert cols.value_ranges(df.limit(0))["a"] == (0, None, None) and cols.value_ranges(df, []) == {}


def test_narrowing_keeps_nan_and_wide_columns(spark):
    wide = spark.range(50).selectExpr("id", *[f"CASE WHEN id % 7 <> {i % 7} THEN id * {i} END AS `c {i}`" for i in range(300)], "CAST('NaN' AS DOUBLE) AS nan")
    out, counts = cols.write_narrowed_counted(wide, "wide", exclude=["id"])
    kinds = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert (kinds["id"], kinds["c 0"], kinds["c 2"], kinds["c 299"], kinds["nan"]) == ("bigint", "tinyint", "tinyint", "smallint", "double")
    assert counts["id"] == counts["nan"] == 50 and counts["c 0"] == 42
    assert sorted(map(str, out.collect())) == sorted(map(str, wide.collect()))


def test_kernel_main_reads_the_joined_table_once_for_all_ranked_steps(spark, monkeypatch):
    def frame(key, prefix, present):  # column i has a value in present[i] of 12 rows
        return spark.range(12).selectExpr(f"id AS {key}", *[f"CASE WHEN id < {n} THEN id + {i} END AS {prefix}{i}" for i, n in enumerate(present)])

    own = {"application": ("c_custkey", "a", [12] * 5), "bureau_and_balance": ("c_custkey", "b", [9, 1, 8]), "previous": ("c_custkey", "p", [2, 7, 3]), "pos": ("user_id", "o", [6]), "instalments": ("c_custkey", "i", [5, 4]), "cards": ("sk_id_curr", "k", [10])}
    for name, (key, prefix, present) in own.items():
        part = frame(key, prefix, present)
        part = part.withColumn("target", F.col(key) % 2) if name == "application" else part
        monkeypatch.setattr(kernel, name, lambda spark, d, part=part: part)
    passes = []
    ranges = cols.value_ranges
    monkeypatch.setattr(cols, "value_ranges", lambda df, columns=None: passes.append(len(df.columns)) or ranges(df, columns))
    out = kernel.kernel_main(spark, "")
    assert len(passes) == 4  # bureau, previous, the loans' table, the whole table
    # b1 and p0 go, i1 of the rest; then two of 12, two of 10, five of 8: the columns with the fewest values
    assert set(out.columns) == {"c_custkey", "target", "a0", "a1", "a2"}
    assert out.count() == 12
