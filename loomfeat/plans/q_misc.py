"""Queries for row expressions, typing, sources/sinks and the user-function extension point
(SURVEY P1-P35, S1-S7, X1)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from loomfeat.functions import exprs as X
from loomfeat.operators import columns as cols
from loomfeat.operators import encode, grouped
from loomfeat.plans import blocks
from loomfeat.plans.catalog import query
from loomfeat.session import scratch_dir
from loomfeat.sources import fixtures as fx
from loomfeat.sources import io


@query("p_application_features")
def q_application(spark, d):
    """Ratios (P9), guarded ratio (P10), weighted sum (P13), row-wise stats (P14), flags."""
    app = blocks.application_frame(spark, d)
    return blocks.application_features(app).drop(*[c for c in app.columns if c != "c_custkey"])


@query("p_scrub_fill")
def q_scrub(spark, d):
    """P1, P2, P5, P6, P11, P12, P20, P21, P22 on order rows."""
    o = fx.bureau(spark, d)
    price_s = X.null_if("o_totalprice", F.col("o_totalprice") > 450000)
    return o.select(
        "o_orderkey",
        X.null_if_equal("o_orderstatus", "P").alias("status_scrubbed"),
        price_s.alias("price_scrubbed"),
        X.fill_from(price_s, F.col("o_days").cast("double")).alias("price_or_days"),
        X.fill_value(price_s, 1.0).alias("price_or_one"),
        X.clamp_zero(F.col("o_days") + 2000).alias("days_clamped"),
        X.complement_ratio("o_totalprice", F.col("o_totalprice") + 1000).alias("price_complement"),
        X.flag_cmp(F.col("o_totalprice") / 1000, -F.col("o_days")).alias("price_gt_age"),
        X.horizontal_sum(
            [X.flag_eq("o_orderstatus", "O"), X.flag_eq("o_orderpriority", "1-URGENT"), X.flag_gt("o_days", -365)]
        ).alias("flag_sum"),
        X.diff("o_totalprice", F.col("o_days") * 100).alias("price_minus_days"),
    )


@query("p31_narrow_types")
def q_narrow(spark, d):
    """The type each numeric column narrows to, from one min/max pass."""
    c = fx.application(spark, d).drop("target")
    narrowed = cols.narrow_types(c)
    rows = [(f.name, f.dataType.simpleString()) for f in narrowed.schema.fields if f.name in cols.numeric_columns(c)]
    return spark.createDataFrame(rows, "column string, narrowed string")


@query("p32_type_split")
def q_type_split(spark, d):
    """Categorical / discrete numeric (< 25 distinct) / continuous numeric columns."""
    o = fx.bureau(spark, d).drop("o_orderdate")
    cat, disc, other = cols.type_split(o)
    rows = [(c, "categorical") for c in cat] + [(c, "discrete") for c in disc] + [(c, "continuous") for c in other]
    return spark.createDataFrame(rows, "column string, kind string")


@query("p33_binary_columns")
def q_binary(spark, d):
    """P33 + P26 + P27: 0/1 columns of a one-hot frame (name pattern and type selection)."""
    o = fx.bureau(spark, d).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    hot, _ = encode.one_hot(o, cols.string_columns(o), clean_names=True)
    binary = set(cols.binary_columns(hot, exclude=["o_orderkey"]))
    names = [c for c in hot.columns if c != "o_orderkey"]
    return spark.createDataFrame([(c, int(c in binary)) for c in names], "column string, is_binary int")


@query("s1_s6_csv_roundtrip")
def q_csv(spark, d):
    """S6 + S1: write the customer table as CSV to the shared scratch folder, scan it back with a schema."""
    c = fx.table(spark, d, "customer")
    path = scratch_dir(spark, "customer-csv")
    c.write.mode("overwrite").option("header", "true").csv(path)
    return io.read_table(spark, path, c.schema, fmt="csv")


@query("s2_capped_scan")
def q_capped(spark, d):
    """The first 100 orders (by key)."""
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return io.capped(o, 100, ["o_orderkey"])


@query("s3_projected_scan")
def q_projected(spark, d):
    """S3: a projected, filtered scan (both pushed into the parquet reader)."""
    li = fx.table(spark, d, "lineitem")
    return io.projected(li, ["l_orderkey", "l_extendedprice", "l_shipdate"]).where(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).drop("l_shipdate")


@query("s4_exact_sample")
def q_sample(spark, d):
    """Exactly 500 orders, repeatable (smallest key hashes)."""
    return io.exact_sample(fx.table(spark, d, "orders").select("o_orderkey", "o_custkey"), 500, "o_orderkey", seed=42)


@query("s5_s7_ranked_list")
def q_ranked_list(spark, d):
    """S7 + S5: write feature importances, read the ranked list back (best first)."""
    c = fx.application(spark, d)
    totals = c.agg(F.sum("c_acctbal").alias("a"), F.sum(F.col("c_nationkey").cast("double")).alias("n"))
    imp = totals.select(F.expr("stack(2, 'c_acctbal', a, 'c_nationkey', n) as (feature, importance)"))
    path = scratch_dir(spark, "importance")
    io.write_importance(imp, path)
    names = io.read_ranked_list(spark, path, "feature", rank_column="importance")
    return spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "feature string, rank int")


def _gap_features(pdf: pd.DataFrame) -> dict:
    ts = pd.to_datetime(pdf["ts"]).sort_values()
    gaps = ts.diff().dt.total_seconds()
    return {"n": int(len(pdf)), "gap_max": float(gaps.max()) if len(pdf) > 1 else None}


@query("x1_grouped_udf")
def q_grouped(spark, d):
    """A per-group pandas feature function (largest gap between a user's events, in seconds)."""
    e = fx.monthly(spark, d).select("user_id", "ts")
    return grouped.per_group_features(e, "user_id", _gap_features, "user_id long, n long, gap_max double")

