"""Queries for the window-style operators and their blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomfeat.functions.exprs import diff, fill_value, flag_eq, flag_gt
from loomfeat.operators import aggregate as agg
from loomfeat.operators import windows as win
from loomfeat.plans.catalog import query
from loomfeat.sources import fixtures as fx

# Fixed values of the instalment blocks (B26-B28): periods, fraction pairs, statistics.
INS_PERIODS = [1, 5, 10, 20, 50, 100]
INS_FRACTIONS = [(5, 20), (5, 50), (10, 100)]
INS_TREND_PERIODS = [10, 50, 100, 500]
NINE = ["sum", "mean", "max", "min", "std", "median", "skew", "kurt", "iqr"]
INS_LAST_K_SPEC = {
    "i_version": NINE,
    "late_days": NINE,
    "paid_late": ["count", "mean"],
    "over_amount": NINE,
    "paid_over": ["count", "mean"],
}
INS_ORDER_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "i_version", "i_due", "i_paid", "i_days_paid"]

# Fixed values of the POS blocks.
POS_PERIODS = [1, 10, 50, None]
POS_TREND_PERIODS = [1, 6, 12, 30, 60]
POS_LAST_K_SPEC = {
    "pos_paid_late": ["count", "mean"],
    "pos_paid_late_tol": ["count", "mean"],
    "sk_dpd": ["sum", "mean", "max", "min", "median"],
    "sk_dpd_def": ["sum", "mean", "max", "min", "median"],
}
POS_LAST_LOAN_SPEC = {
    "pos_paid_late": ["count", "sum", "mean"],
    "pos_paid_late_tol": ["sum", "mean"],
    "sk_dpd": ["sum", "mean", "max", "min", "std"],
    "sk_dpd_def": ["sum", "mean", "max", "min", "std"],
}


def instalment_rows(spark, d):
    """Block B22's rows with its derived columns."""
    return instalment_features(fx.installments(spark, d))


def instalment_features(i):
    """Block B22's derived columns: late days/flag (P11/P17), over-payment amount/flag."""
    late = diff("i_days_paid", "i_days_due")
    over = diff("i_paid", "i_due")
    return i.select(
        "*",
        late.alias("late_days"),
        flag_gt(late, 0).alias("paid_late"),
        over.alias("over_amount"),
        flag_gt(over, 0).alias("paid_over"),
    )


def pos_rows(spark, d):
    """Block B29's columns on the monthly history: DPD, DPD with tolerance, their flags."""
    e = fx.monthly(spark, d)
    dpd = F.floor(F.col("value") / 10).cast("int")
    dpd_def = F.when(F.col("event_type") == "error", dpd).otherwise(F.lit(0))
    return e.select(
        "user_id", "event_id", "event_type", "ts", "e_days", "value",
        dpd.alias("sk_dpd"),
        dpd_def.alias("sk_dpd_def"),
        (dpd - dpd_def).alias("sk_dpd_diff"),
        flag_gt(dpd, 0).alias("pos_paid_late"),
        flag_gt(dpd_def, 0).alias("pos_paid_late_tol"),
    )


def instalment_last_k(spark, d):
    rows = instalment_rows(spark, d)
    return win.last_k(rows, "o_custkey", ["i_days_due"], INS_LAST_K_SPEC, INS_PERIODS, tiebreak=INS_ORDER_TIEBREAK)


@query("w3_last_k_instalments")
def q_last_k(spark, d):
    """W3 (block B26): 31 statistics of each customer's newest k instalments, k = 1..100."""
    return instalment_last_k(spark, d)


@query("w8_last_k_fractions")
def q_fractions(spark, d):
    """W8 (block B27): short/long ratios of the last-k statistics."""
    lk = instalment_last_k(spark, d)
    out = win.fraction_features(lk, INS_FRACTIONS, INS_LAST_K_SPEC)
    return out.select("o_custkey", *[c for c in out.columns if "_fraction_" in c])


@query("w7_trend_instalments")
def q_trend_ins(spark, d):
    """W7 (block B28): least-squares trend of late days and over-payment over the newest k rows."""
    rows = instalment_rows(spark, d)
    trend = {k: ["late_days", "over_amount"] for k in INS_TREND_PERIODS}
    return win.last_k(rows, "o_custkey", ["i_days_due"], {}, [], tiebreak=INS_ORDER_TIEBREAK, trend=trend)


@query("w4_pos_last_k")
def q_pos_last_k(spark, d):
    """W3 + W4 (block B32): newest 1/10/50 months and the whole history per user."""
    rows = pos_rows(spark, d)
    return win.last_k(rows, "user_id", ["ts"], POS_LAST_K_SPEC, POS_PERIODS, tiebreak=["event_id"])


@query("w7_trend_pos")
def q_trend_pos(spark, d):
    """W7 (block B34): DPD trends over the newest 1/6/12/30/60 months."""
    rows = pos_rows(spark, d)
    trend = {k: ["sk_dpd", "sk_dpd_def"] for k in POS_TREND_PERIODS}
    return win.last_k(rows, "user_id", ["ts"], {}, [], tiebreak=["event_id"], trend=trend)


@query("w6_latest_loan")
def q_latest_loan(spark, d):
    """W6 (block B33): statistics over the loan that owns the user's newest row."""
    rows = pos_rows(spark, d)
    return win.latest_loan(rows, "user_id", "event_type", ["ts", "event_id"], POS_LAST_LOAN_SPEC)


# Fixed values of block B42: number of newest contracts.
PREV_TAIL_K = [1, 3, 5]


@query("w5_tail_k_contracts")
def q_tail_k(spark, d):
    """W5 (block B42): mean of 3 columns over each customer's newest 1/3/5 orders, filled 0."""
    o = fx.bureau(spark, d).withColumn("urgent", flag_eq("o_orderpriority", "1-URGENT"))
    spec = {"o_totalprice": ["mean"], "o_days": ["mean"], "urgent": ["mean"]}
    out = win.last_k(o, "o_custkey", ["o_days", "o_orderkey"], spec, PREV_TAIL_K, namer=lambda k, c, f: f"prev_last_{k}_{c}_{f}")
    return out.na.fill(0)


@query("w2_prolongation")
def q_prolongation(spark, d):
    """W9 + W2 + P6 (block B25): gap to the next instalment number per loan, filled 1, aggregated."""
    rows = instalment_rows(spark, d).select("o_custkey", "l_orderkey", "i_version", "l_linenumber", "i_paid")
    first = win.dedup_first(rows, ["o_custkey", "l_orderkey", "i_version"], ["l_linenumber"])
    nxt = win.lead_within(first, ["o_custkey", "l_orderkey"], ["l_linenumber", "i_version", "i_paid"], "l_linenumber", "__next")
    pay = nxt.select(
        "o_custkey",
        fill_value(F.col("__next") - F.col("l_linenumber"), 1).cast("double").alias("pay_long"),
        "i_paid",
    ).select("o_custkey", "pay_long", (F.col("i_paid") * F.col("pay_long")).alias("pay_long_amount"))
    fns = ["mean", "sum", "min", "median", "max", "std"]
    return agg.aggregate(pay, "o_custkey", {"pay_long": fns, "pay_long_amount": fns}, prefix="ins_")


@query("w9_dedup_first")
def q_dedup_first(spark, d):
    """First row per (customer, loan, version) by instalment number, full tie-break."""
    rows = instalment_rows(spark, d).select("o_custkey", "l_orderkey", "i_version", "l_linenumber", "i_paid")
    return win.dedup_first(rows, ["o_custkey", "l_orderkey", "i_version"], ["l_linenumber"])


@query("w10_dedup_last")
def q_dedup_last(spark, d):
    """Last row per (user, loan) among non-zero DPD rows, by time."""
    rows = pos_rows(spark, d).where(F.col("sk_dpd") != 0).select("user_id", "event_type", "ts", "event_id", "value")
    out = win.dedup_last(rows, ["user_id", "event_type"], ["ts", "event_id"])
    return out.drop("ts")


@query("w1_lag_usage")
def q_lag(spark, d):
    """W1 + P5 + P11 (block B17): previous value per (user, loan), balance change and use flag."""
    rows = pos_rows(spark, d).select("user_id", "event_type", "ts", "event_id", "value")
    lagged = win.lag_within(rows, ["user_id", "event_type"], ["ts", "event_id"], "value", "prev_value")
    return lagged.select(
        "event_id",
        "user_id",
        F.coalesce(F.col("prev_value"), F.col("value")).alias("prev_value_filled"),
        (F.col("value") - F.col("prev_value")).alias("value_change"),
        flag_gt(F.col("value") - F.col("prev_value"), 0).alias("use_flag"),
    )


@query("w1_lag_usage_rank")
def q_lag_rank(spark, d):
    """W1 via distributed ranks and an equi-join (no (user, loan) sequence sorted in one task)."""
    rows = pos_rows(spark, d).select("user_id", "event_type", "ts", "event_id", "value")
    lagged = win.lag_within(rows, ["user_id", "event_type"], ["ts", "event_id"], "value", "prev_value", method="rank")
    return lagged.select(
        "event_id",
        "user_id",
        F.coalesce(F.col("prev_value"), F.col("value")).alias("prev_value_filled"),
        (F.col("value") - F.col("prev_value")).alias("value_change"),
        flag_gt(F.col("value") - F.col("prev_value"), 0).alias("use_flag"),
    )
