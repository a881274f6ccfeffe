"""Queries for the aggregation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomfeat.functions import aggfns
from loomfeat.functions.exprs import flag_eq, flag_gt, flag_in, null_if, null_if_equal
from loomfeat.operators import aggregate as agg
from loomfeat.operators import joins
from loomfeat.plans.catalog import order_activity, query
from loomfeat.sources import fixtures as fx


@query("a01_a12_functions")
def q_functions(spark, d):
    """Every aggregate function of a spec, per supplier over line items."""
    li = fx.balance(spark, d)
    spec = {
        "l_quantity": ["min", "max", "mean", "sum", "std", "var", "median", "count", "size", "nunique", "skew", "kurt", "iqr"],
        "l_discount": ["nonzero", "mean", "max"],
    }
    return agg.aggregate(li, "l_suppkey", spec, prefix="li_")


@query("a13_first_valid")
def q_first_valid(spark, d):
    """A13/N13 + P1: latest non-missing value per customer (price of non-pending orders)."""
    o = fx.bureau(spark, d).withColumn("price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    first = aggfns.agg_first_valid(F.struct("o_orderdate", "o_orderkey"))
    return o.groupBy("o_custkey").agg(first(F.col("price")).alias("last_valid_price"))


# Category values of o_orderpriority (the kernel's one-hot share columns).
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("a14_category_share")
def q_share(spark, d):
    """A14 + A21: share of each order priority per customer, overall and for open orders."""
    o = fx.bureau(spark, d)
    values = agg.category_domain(o, "o_orderpriority")
    spec = {"o_orderpriority": [(f"share_{agg.sanitize(v)}", aggfns.agg_share(v)) for v in values]}
    slices = [agg.ALL, agg.eq_slice("opn", "o_orderstatus", "O")]
    return agg.aggregate(o, "o_custkey", spec, slices, prefix="ord_")


@query("a22_naive_slices")
def q_naive(spark, d):
    """A21/A22 in the reference's shape (filter, aggregate, join per slice): the fused form's baseline."""
    return order_activity(spark, d, fused=False)


@query("a23_category_slices")
def q_category_slices(spark, d):
    """The same spec repeated for every value of a category, fused into one aggregate."""
    o = fx.bureau(spark, d)
    values = agg.category_domain(o, "o_orderpriority")
    slices = agg.value_slices("o_orderpriority", values)
    spec = {"o_totalprice": ["mean", "max", "size"], "o_days": ["min"]}
    return agg.aggregate(o, "o_custkey", spec, slices, prefix="pri_")


def balance_rows(spark, d):
    """A29 + J3: loans left-joined with their pre-aggregated (loan, status) counts."""
    loans = fx.bureau(spark, d).select("o_custkey", "o_orderkey")
    bb = fx.balance(spark, d).groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("months"))
    rows = loans.join(bb, loans.o_orderkey == bb.l_orderkey, "left").drop("l_orderkey")
    # overdue = status in the overdue set (missing status -> 0)
    return rows.withColumn("overdue", flag_in("l_returnflag", [fx.OVERDUE_RETURNFLAG]))


@query("a24_two_level")
def q_two_level(spark, d):
    """A24 (block B12): overdue mean/sum per loan, then mean/max/std/sum/median per customer."""
    rows = balance_rows(spark, d).withColumn("overdue", F.col("overdue").cast("double"))
    return agg.two_level(rows, "o_custkey", "o_orderkey", {"overdue": ["mean", "sum"]}, ["mean", "max", "std", "sum", "median"], prefix="bureau_")


@query("a25_missing_counts")
def q_missing(spark, d):
    """A25 + P1/P2: per customer, rows with a missing value, for every column that has one."""
    o = fx.bureau(spark, d).select(
        "o_custkey",
        null_if_equal("o_orderstatus", "P").alias("o_orderstatus"),
        null_if("o_totalprice", F.col("o_totalprice") > 450000).alias("o_totalprice"),
        "o_orderpriority",
    )
    return agg.missing_counts(o, "o_custkey", prefix="credit_")


def bureau_amounts(spark, d):
    """Bureau-like amounts on orders: credit, debt (open orders), overdue (urgent open orders)."""
    o = fx.bureau(spark, d)
    is_open = F.col("o_orderstatus") == "O"
    return o.select(
        "o_custkey",
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_days",
        F.col("o_totalprice").alias("amt_credit"),
        F.when(is_open, F.col("o_totalprice")).otherwise(F.lit(0.0)).alias("amt_debt"),
        F.when(is_open & (F.col("o_orderpriority") == "1-URGENT"), F.col("o_totalprice")).otherwise(F.lit(0.0)).alias("amt_overdue"),
    )


@query("a26_totals_ratio")
def q_totals(spark, d):
    """A26 (block B7): debt/credit/overdue totals per customer and guarded ratios of them."""
    b = bureau_amounts(spark, d)
    return agg.ratio_of_totals(
        b,
        "o_custkey",
        {"bureau_total_customer_debt": "amt_debt", "bureau_total_customer_credit": "amt_credit", "bureau_total_customer_overdue": "amt_overdue"},
        {
            "bureau_debt_credit_ratio": ("bureau_total_customer_debt", "bureau_total_customer_credit"),
            "bureau_overdue_debt_ratio": ("bureau_total_customer_overdue", "bureau_total_customer_debt"),
        },
    )


@query("a27_category_counts")
def q_category_counts(spark, d):
    """A27 (block B41): per customer, count of orders per priority and per status (absent -> NULL)."""
    o = fx.bureau(spark, d)
    a = agg.category_counts(o, "o_custkey", "o_orderpriority", prefix="prev_o_orderpriority_", absent_as_null=True)
    b = agg.category_counts(o, "o_custkey", "o_orderstatus", prefix="prev_o_orderstatus_", absent_as_null=True)
    return a.join(b, "o_custkey", "left")


@query("a28_status_rates")
def q_status_rates(spark, d):
    """A28 (block B13): per customer, (loan, status) combinations per status, total and shares."""
    rows = balance_rows(spark, d)
    return agg.category_counts(rows, "o_custkey", "l_returnflag", prefix="balance_l_returnflag_", with_rates=True)


@query("a30_latest_period")
def q_latest_period(spark, d):
    """A30 (block B31): per user, statistics of the newest day with events."""
    e = fx.monthly(spark, d)
    return agg.latest_period(e, "user_id", "e_days", {"value": ["mean", "min", "max", "sum"]}, prefix="pos_last_")


def bureau_flags(spark, d):
    """Flags of block B4 on the bureau-like rows."""
    b = bureau_amounts(spark, d)
    return b.select(
        "o_custkey",
        flag_eq("o_orderstatus", "O").alias("active_flag"),
        flag_gt("o_days", -365).alias("enddate_flag"),
        flag_gt("amt_overdue", 0).alias("overdue_flag"),
        flag_gt("amt_debt", 0).alias("using_flag"),
    )


@query("a32_flag_stats")
def q_flag_stats(spark, d):
    """A32 (block B6): mean/sum/count of every '*flag*' column per customer."""
    return agg.flag_stats(bureau_flags(spark, d), "o_custkey", prefix="credit_")


@query("a15_global_stats")
def q_global(spark, d):
    """Whole-column statistics in one row."""
    li = fx.balance(spark, d)
    return agg.global_stats(li, ["l_quantity", "l_extendedprice"], ["min", "max", "median", "mean", "nulls", "nunique"])


@query("j2_validated_join")
def q_validated(spark, d):
    """J2 + J1 + P35: spine of order customers, validated one-to-one join of two feature blocks."""
    o = fx.bureau(spark, d)
    spine = o.select("o_custkey").distinct()
    a = agg.aggregate(o, "o_custkey", {"o_totalprice": ["sum", "size"]}, prefix="v_")
    b = agg.aggregate(o, "o_custkey", {"o_days": ["max"]}, prefix="v_")
    return joins.validated_left_join(joins.validated_left_join(spine, a, "o_custkey"), b, "o_custkey")


@query("j5_label_propagation")
def q_label(spark, d):
    """The entity label mapped onto every child row."""
    o = fx.bureau(spark, d).select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = fx.application(spark, d)
    return joins.propagate_label(o, c, "c_custkey", "target")


@query("j8_name_collision")
def q_collision(spark, d):
    """Two blocks with the same feature names; the right side's names get a suffix."""
    o = fx.bureau(spark, d)
    a = agg.aggregate(o, "o_custkey", {"o_totalprice": ["mean"]}, prefix="x_")
    b = agg.aggregate(o.where(F.col("o_orderstatus") == "F"), "o_custkey", {"o_totalprice": ["mean"]}, prefix="x_")
    return a.join(joins.dedupe_columns(a, b, "o_custkey"), "o_custkey", "left")


@query("a06_quantiles_rank_mode")
def q_rank_quantiles(spark, d):
    """A6/A12 with hot-key-safe exact quantiles: per customer and status slice, via ranks."""
    o = fx.bureau(spark, d)
    slices = [agg.ALL, agg.eq_slice("opn", "o_orderstatus", "O")]
    return agg.aggregate(o, "o_custkey", {"o_totalprice": ["median", "iqr"], "o_days": ["median"]}, slices, prefix="q_")


@query("p07_p08_global_fills")
def q_global_fills(spark, d):
    """P7 + P8: missing values filled with the global median / mean of the column."""
    from loomfeat.operators import columns as cols
    from loomfeat.functions.exprs import null_if

    o = fx.bureau(spark, d).select(
        "o_orderkey",
        null_if("o_totalprice", F.col("o_orderstatus") == "P").alias("price_med"),
        null_if("o_totalprice", F.col("o_orderstatus") == "P").alias("price_mean"),
    )
    return cols.fill_mean(cols.fill_median(o, ["price_med"]), ["price_mean"])
