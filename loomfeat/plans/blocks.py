"""Feature blocks as compositions of the operators.

Blocks are written against the driver's tables through the role mapping of
``loomfeat.sources.fixtures``; column roles are parameters with the mapped
names as defaults. Every block returns one row per entity of the application
table, with 0 where an entity has no child row, as the reference's drivers do.

Physical shape of a block: everything that is a statistic of the child rows by
the entity key (missing counts, flags, totals, status slices) is one
``aggregate_parts``: one scan and one exchange, and one more of each for all
of its medians; windows and second levels are parts of their own. The parts are written once as Parquet, pruned in the
reference's scopes, joined to the spine and checked to be one row per entity
while the join runs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.functions import exprs as X
from loomfeat.operators import aggregate as agg
from loomfeat.operators import columns as cols
from loomfeat.operators import encode, joins, select
from loomfeat.operators import windows as win
from loomfeat.session import free_shuffles, held, written
from loomfeat.sources import fixtures as fx

SIX = ["min", "median", "max", "mean", "sum", "std"]
FIVE = ["min", "median", "max", "mean", "std"]
KEY = "sk_id_curr"


def _prune(df: DataFrame, key: str | None, threshold: float | None, columns: Sequence[str] | None = None) -> DataFrame:
    """F1 over one scope of a written part, or nothing when disabled.

    ``columns`` is the scope (all numeric columns, if not given). A ``key`` comes first in
    it and takes part, but is never dropped.
    """
    if threshold is None:
        return df
    scope = [c for c in (columns if columns is not None else cols.numeric_columns(df)) if c != key and c in df.columns]
    out, _ = select.correlation_prune(df, threshold, protect=[key] if key else [], columns=[key, *scope] if key else scope)
    return out


def _missing(columns: Sequence[str], prefix: str) -> list:
    """A25 as expressions of a fused aggregate: rows of the key where a column is NULL, NULL if none."""
    out = []
    for c in columns:
        n = F.count_if(F.col(c).isNull())
        out.append(F.when(n > 0, n).alias(f"{prefix}{c}_miss_times"))
    return out


def _without_empty(df: DataFrame, suffix: str = "_miss_times") -> DataFrame:
    """Drop the missing counts that no key has (the reference counts only columns with a NULL)."""
    counts = [c for c in df.columns if c.endswith(suffix)]
    if not counts:
        return df
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in counts]).first()
    return df.drop(*[c for c in counts if row[c] == 0])


def entities(spark: SparkSession, d: str, key: str = KEY) -> DataFrame:
    """The spine of every driver: the keys of the application table."""
    return fx.application(spark, d).select(F.col("c_custkey").alias(key))


def _on_spine(spark: SparkSession, d: str, parts: Sequence[DataFrame], key: str = KEY, validate: bool = True, known: DataFrame | None = None) -> DataFrame:
    """Spine left-joined with the parts (J4), 0 where an entity has none (P3), one row each.

    ``known`` has every key that any of the parts has; entities that are not in it are not
    taken through the joins.
    """
    spine = entities(spark, d, key)
    block = spine_join(spine, parts, key, known)
    return joins.unique_rows(block, key, "block") if validate else block


def spine_join(spine: DataFrame, parts: Sequence[DataFrame], key: str, known: DataFrame | None = None) -> DataFrame:
    """J4 and P3. With ``known`` a row of the spine without a part becomes its zeros as literals:
    sorting, joining and filling hundreds of columns is only paid for rows that have them."""
    if known is None:
        return cols.fill_zero(joins.join_chain(spine, parts, key))
    known = known.select(key)
    block = cols.fill_zero(joins.join_chain(spine.join(known, key, "left_semi"), parts, key))
    lone = cols.fill_zero(spine.join(known, key, "left_anti"))

    def zero(f: T.StructField) -> str:
        value = "0" if isinstance(f.dataType, T.NumericType) else "NULL"
        return f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`"

    return block.union(lone.selectExpr(*[f"`{f.name}`" if f.name in spine.columns else zero(f) for f in block.schema.fields]))


# ------------------------------------------------------------------ B1-B3: application


def load_split(labelled: DataFrame, unlabelled: DataFrame, key: str, label: str, train_fraction: float = 0.9, seed: int = 1222):
    """B1: cut labelled rows 90/10 in hash order (exactly), tag 1/0/-1, union with the unlabelled rows.

    Returns (main without the label, y_train, y_test).
    """
    from loomfeat.operators.scoring import split_flag
    from loomfeat.operators.setops import union_frames

    lab = split_flag(labelled, key, train_fraction, seed)
    y_train = lab.where(F.col("is_train") == 1).select(key, label)
    y_test = lab.where(F.col("is_train") == 0).select(key, label)
    main = union_frames([lab.drop(label), unlabelled.drop(label).withColumn("is_train", F.lit(-1))])
    return main, y_train, y_test


def application_frame(spark: SparkSession, d: str) -> DataFrame:
    """The application table on the driver's data: customer plus a per-customer order summary.

    Role names follow the reference (income, credit, annuity, goods price,
    birth and employment offsets, children, family size, three scores).
    """
    c = fx.application(spark, d)
    o = fx.bureau(spark, d)

    def share(v):
        return F.avg((F.col("o_orderpriority") == v).cast("double"))

    summary = o.groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("amt_credit"),
        F.avg("o_totalprice").alias("amt_annuity"),
        F.max("o_totalprice").alias("amt_goods_price"),
        F.min("o_days").alias("days_birth"),
        F.max("o_days").alias("days_employed"),
        F.count_if(F.col("o_orderstatus") == "O").alias("cnt_children"),
        F.count(F.lit(1)).alias("cnt_fam_members"),
        (F.max(F.col("o_orderkey")) % 30).cast("double").alias("own_car_age"),
        X.null_if_equal(F.min("o_orderkey") % 5 * -100, 0).alias("days_last_phone_change"),
        share("1-URGENT").alias("ext_source_1"),
        share("2-HIGH").alias("ext_source_2"),
        share("3-MEDIUM").alias("ext_source_3"),
    )
    app = c.select("c_custkey", "target", "c_mktsegment", F.col("c_acctbal").alias("amt_income_total"))
    return app.join(summary.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")


# Fixed values of block B3: flag thresholds and score weights.
SHORT_EMPLOYMENT_DAYS = -2000
YOUNG_AGE_DAYS = -14000
EXT_WEIGHTS = {"ext_source_1": 2, "ext_source_2": 3, "ext_source_3": 4}


def application_features(app: DataFrame) -> DataFrame:
    """14 ratios (one guarded), weighted scores, 6 row-wise statistics, 2 flags."""
    ext = ["ext_source_1", "ext_source_2", "ext_source_3"]
    return app.select(
        "*",
        X.ratio("amt_annuity", "amt_income_total").alias("annuity_income_percentage"),
        X.ratio("own_car_age", "days_birth").alias("car_to_birth_ratio"),
        X.ratio("own_car_age", "days_employed").alias("car_to_employ_ratio"),
        X.ratio("cnt_children", "cnt_fam_members").alias("children_ratio"),
        X.ratio("amt_credit", "amt_annuity").alias("credit_to_annuity_ratio"),
        X.ratio("amt_credit", "amt_goods_price").alias("credit_to_goods_ratio"),
        X.ratio("amt_credit", "amt_income_total").alias("credit_to_income_ratio"),
        X.ratio("days_employed", "days_birth").alias("days_employed_percentage"),
        X.ratio("amt_income_total", "amt_credit").alias("income_credit_percentage"),
        X.guarded_ratio("amt_income_total", "cnt_children").alias("income_per_child"),
        X.ratio("amt_income_total", "cnt_fam_members").alias("income_per_person"),
        X.ratio("amt_annuity", "amt_credit").alias("payment_rate"),
        X.ratio("days_last_phone_change", "days_birth").alias("phone_to_birth_ratio"),
        X.ratio("days_last_phone_change", "days_employed").alias("phone_to_employ_ratio"),
        X.weighted_sum(EXT_WEIGHTS).alias("external_sources_weighted"),
        X.row_min(ext).alias("external_sources_min"),
        X.row_max(ext).alias("external_sources_max"),
        X.row_sum(ext).alias("external_sources_sum"),
        X.row_mean(ext).alias("external_sources_mean"),
        X.row_median(ext).alias("external_sources_nanmedian"),
        X.row_std(ext).alias("external_sources_std"),
        X.flag_gt("days_employed", SHORT_EMPLOYMENT_DAYS).alias("short_employment"),
        X.flag_gt("days_birth", YOUNG_AGE_DAYS).alias("young_age"),
    )


def woe_block(main: DataFrame, labelled: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """B2: WOE of every categorical column, fitted on the labelled rows, joined back."""
    return encode.woe_encode(main, columns, target, fit_on=labelled)


# ------------------------------------------------------------------ B4-B9: bureau


def bureau_rows(spark: SparkSession, d: str) -> DataFrame:
    """Bureau-like rows on orders with the reference's role names and flags (B4 prologue)."""
    o = fx.bureau(spark, d)
    is_open = F.col("o_orderstatus") == "O"
    rows = o.select(
        F.col("o_custkey").alias("sk_id_curr"),
        F.col("o_orderkey").alias("sk_id_bureau"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Active"))
        .when(F.col("o_orderstatus") == "F", F.lit("Closed"))
        .alias("credit_active"),  # 'P' orders -> missing status
        F.col("o_orderpriority").alias("credit_type"),
        F.col("o_days").alias("days_credit"),
        (F.col("o_days") + F.lit(30) * (F.col("o_orderkey") % 13)).alias("days_credit_enddate"),
        F.col("o_totalprice").alias("amt_credit_sum"),
        F.when(is_open, F.col("o_totalprice")).otherwise(F.lit(0.0)).alias("amt_credit_sum_debt"),
        F.when(is_open & (F.col("o_orderpriority") == "1-URGENT"), F.col("o_totalprice")).otherwise(F.lit(0.0)).alias("amt_credit_sum_overdue"),
        X.null_if_equal(F.col("o_totalprice") / 12, 0).alias("amt_annuity"),
    )
    # Impossible offsets become missing; P17/P18 flags
    rows = rows.withColumn("days_credit_enddate", X.null_if("days_credit_enddate", F.col("days_credit_enddate") < -40000))
    return rows.select(
        "*",
        X.flag_eq("credit_active", "Active").alias("active_flag"),
        X.flag_gt("days_credit_enddate", 0).alias("enddate_flag"),
        X.flag_gt("amt_credit_sum_overdue", 0).alias("overdue_flag"),
        X.flag_gt("amt_credit_sum_debt", 0).alias("using_flag"),
    )


BUREAU_DAYS = ["days_credit_enddate", "days_credit"]
BUREAU_AMT = ["amt_credit_sum", "amt_credit_sum_debt", "amt_credit_sum_overdue", "amt_annuity"]


def bureau_part(b: DataFrame, key: str = KEY) -> DataFrame:
    """B5-B9 in one aggregate: missing counts, flag statistics, debt totals, active and closed statistics."""
    # 0 on the raw rows for the status statistics only
    b = b.select(
        "*",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"z_{c}") for c in BUREAU_DAYS + BUREAU_AMT],
    ).select(
        "*",
        X.guarded_ratio("z_amt_credit_sum_debt", "z_amt_credit_sum").alias("z_amt_credit_debt_rate"),
        X.diff("z_amt_credit_sum", "z_amt_credit_sum_debt").alias("z_amt_credit_debt_remain"),
        X.guarded_ratio("z_amt_credit_sum_debt", "z_amt_annuity").alias("z_amt_credit_months"),
    )
    active = F.col("credit_active") == "Active"
    act = {f"z_{c}": SIX for c in BUREAU_DAYS + BUREAU_AMT + ["amt_credit_debt_rate", "amt_credit_debt_remain", "amt_credit_months"]}
    cls = {f"z_{c}": SIX for c in BUREAU_DAYS + BUREAU_AMT + ["amt_credit_debt_rate"]}
    namer = lambda p, c, t, f: f"credit_{t}_{c[2:]}_{f}"
    parts = [
        agg.Part({c: ["mean", "sum", "count"] for c in b.columns if "flag" in c}, prefix="credit_"),  # B6
        agg.Part(act, [agg.Slice("active", active, "`credit_active` = 'Active'")], namer=namer),  # B8
        # P23: '!=' keeps rows with a missing status (pandas semantics)
        agg.Part(cls, [agg.Slice("closed", ~F.coalesce(active, F.lit(False)), "NOT coalesce(`credit_active` = 'Active', false)")], namer=namer),  # B9
    ]
    raw = [c for c in b.columns if not c.startswith("z_") and c not in (key, "sk_id_bureau")]
    totals = {"bureau_total_customer_debt": "amt_credit_sum_debt", "bureau_total_customer_credit": "amt_credit_sum", "bureau_total_customer_overdue": "amt_credit_sum_overdue"}
    out = agg.aggregate_parts(b, key, parts, [*_missing(raw, "credit_"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(n) for n, c in totals.items()]])
    return out.select(  # B7: ratios of the totals
        "*",
        X.guarded_ratio("bureau_total_customer_debt", "bureau_total_customer_credit").alias("bureau_debt_credit_ratio"),
        X.guarded_ratio("bureau_total_customer_overdue", "bureau_total_customer_debt").alias("bureau_overdue_debt_ratio"),
    )


def bureau_block(spark: SparkSession, d: str, corr_threshold: float | None = 0.9) -> DataFrame:
    """B4 (B5-B9): missing counts, flag stats, debt totals, active and closed statistics."""
    part = _without_empty(written(bureau_part(bureau_rows(spark, d)), "bureau"))
    for status in ("credit_active_", "credit_closed_"):
        stats = [c for c in part.columns if c.startswith(status) and c != "credit_active_miss_times" and "flag" not in c]
        part = _prune(part, KEY, corr_threshold, stats)
    return _on_spine(spark, d, [part]).withColumnRenamed(KEY, "c_custkey")


# ------------------------------------------------------------------ B10-B13: balance


def balance_part(rows: DataFrame, statuses: Sequence[str], key: str = KEY, loan: str = "sk_id_bureau") -> DataFrame:
    """B11-B13 from (loan, status) rows: per loan first, then one aggregate per entity."""
    names = [f"balance_status_{agg.sanitize(str(v))}" for v in statuses]
    per_loan = rows.groupBy(key, loan).agg(
        F.avg("overdue").alias("overdue_mean"),
        F.sum("overdue").alias("overdue_sum"),
        F.count_if(F.col("status").isNull()).alias("missing"),
        *[F.count_if(F.col("status") == v).alias(n) for v, n in zip(statuses, names)],
    )
    missing = F.sum("missing")
    part = agg.aggregate_parts(
        per_loan,
        key,
        [agg.Part({c: ["mean", "max", "std", "sum", "median"] for c in ("overdue_mean", "overdue_sum")}, prefix="bureau_")],
        [F.when(missing > 0, missing).alias("bureau_miss_time"), *[F.sum(n).alias(n) for n in names]],
    )
    total = sum((F.col(n) for n in names), F.lit(0).cast("long"))
    # the status table has no row for an entity whose loans all lack a status
    seen = part.select(*[c for c in part.columns if c not in names], *[F.when(total > 0, F.col(n)).alias(n) for n in names], F.when(total > 0, total).alias("status_total"))
    return seen.select("*", *[X.ratio(n, "status_total").alias(f"{n}_rate") for n in names])


def balance_block(spark: SparkSession, d: str, corr_threshold: float | None = 0.9) -> DataFrame:
    """B10 (B11-B13): loans left-joined with (loan, status) counts; missing, overdue, status shares."""
    loans = fx.bureau(spark, d).select(F.col("o_custkey").alias(KEY), F.col("o_orderkey").alias("sk_id_bureau"))
    bb = fx.balance(spark, d).groupBy(F.col("l_orderkey").alias("sk_id_bureau"), F.col("l_returnflag").alias("status")).agg(
        F.count(F.lit(1)).alias("months")
    )  # A29: eager pre-aggregation
    rows = loans.join(bb, "sk_id_bureau", "left").withColumn("overdue", X.flag_in("status", [fx.OVERDUE_RETURNFLAG]).cast("double"))
    part = written(balance_part(rows, agg.category_domain(fx.balance(spark, d), "l_returnflag")), "balance")
    part = _prune(part, KEY, corr_threshold, [c for c in part.columns if c.startswith("bureau_overdue_")])  # B12
    block = _prune(_written_if(_on_spine(spark, d, [part]), corr_threshold, "balance"), KEY, corr_threshold)
    return block.withColumnRenamed(KEY, "c_custkey")


def _written_if(df: DataFrame, corr_threshold: float | None, name: str) -> DataFrame:
    """The block written once, when a last pruning is to read it twice."""
    return df if corr_threshold is None else written(df, name)


# ------------------------------------------------------------------ B22-B28: instalments


def instalment_block(spark: SparkSession, d: str, corr_threshold: float | None = 0.9) -> DataFrame:
    """B22 (B23-B28): basic, advanced, prolongation, last-k with fractions, trends.

    Line items meet their orders once, in a table that all passes read; the shuffle files of
    a pass go before the next one begins.
    """
    from loomfeat.plans import q_win as W

    key = "o_custkey"
    basic_cols = ["i_due", "i_paid", "i_days_paid", "i_days_due", "l_linenumber", "i_version"]
    nine = ["sum", "mean", "median", "min", "max", "std", "iqr", "skew", "kurt"]
    flags = {"paid_late": ["sum", "mean", "count"], "paid_over": ["sum", "mean", "count"]}
    with held(fx.installments(spark, d), "instalment-rows") as i:
        rows = W.instalment_features(i)
        # B23 + B24 share one aggregate (same rows, same key)
        basic = agg.aggregate_parts(
            rows,
            key,
            [
                agg.Part({c: ["mean", "min", "max", "median", "sum", "std"] for c in basic_cols}, prefix="ins_"),
                agg.Part({"late_days": nine, "over_amount": nine}),
                agg.Part(flags),
            ],
        )
        basic = written(basic, "instalment-basic", "zstd")
        free_shuffles(spark)
        # prolongation
        first = win.dedup_first(rows.select(key, "l_orderkey", "i_version", "l_linenumber", "i_paid"), [key, "l_orderkey", "i_version"], ["l_linenumber"])
        nxt = win.lead_within(first, [key, "l_orderkey"], ["l_linenumber", "i_version", "i_paid"], "l_linenumber", "__next")
        pay = nxt.select(key, X.fill_value(F.col("__next") - F.col("l_linenumber"), 1).cast("double").alias("pay_long"), "i_paid")
        pay = pay.select(key, "pay_long", (F.col("i_paid") * F.col("pay_long")).alias("pay_long_amount"))
        with held(pay, "instalment-pay") as pay:
            prelong = written(agg.aggregate(pay, key, {"pay_long": SIX, "pay_long_amount": SIX}, prefix="ins_"), "instalment-prolongation")
        # B26 + B27 + B28: one window, one array per key
        trend = {k: ["late_days", "over_amount"] for k in W.INS_TREND_PERIODS}
        lk = win.last_k(i, key, ["i_days_due"], W.INS_LAST_K_SPEC, W.INS_PERIODS, tiebreak=W.INS_ORDER_TIEBREAK, trend=trend, derive=W.instalment_features)
        lk = written(win.fraction_features(lk, W.INS_FRACTIONS, W.INS_LAST_K_SPEC), "instalment-last-k", "zstd")
    basic = _prune(basic, None, corr_threshold, [f"{c}_{f}" for c, fns in flags.items() for f in fns])
    prelong = _prune(prelong, key, corr_threshold)
    lk = _prune_last_k(lk, key, corr_threshold)
    return _on_spine(spark, d, [basic, prelong, lk], key).withColumnRenamed(key, "c_custkey")


def _prune_last_k(lk: DataFrame, key: str, corr_threshold: float | None) -> DataFrame:
    """B26 prunes the last-k statistics; B27 has them once more before its fractions and prunes both; B28 prunes nothing.

    A statistic goes only if both scopes drop it, which they do alike: it precedes the fractions in both.
    """
    if corr_threshold is None:
        return lk
    stats = [c for c in lk.columns if c.startswith("last_")]
    return _prune(lk, key, corr_threshold, [c for c in stats if "_fraction_" not in c] + [c for c in stats if "_fraction_" in c])


# ------------------------------------------------------------------ B29-B34: POS


def pos_block(spark: SparkSession, d: str, corr_threshold: float | None = 0.9) -> DataFrame:
    """B29 (B30-B34): basic, last record, last-k, last loan, trends, per entity."""
    from loomfeat.plans import q_win as W

    rows = W.pos_rows(spark, d)
    key = "user_id"
    basic = agg.aggregate(rows, key, {c: ["mean", "median", "min", "max", "sum", "std"] for c in ["sk_dpd", "sk_dpd_def", "e_days", "sk_dpd_diff"]}, prefix="pos_")
    basic = _prune(_written_if(basic, corr_threshold, "pos-basic"), key, corr_threshold)
    last = agg.latest_period(rows, key, "e_days", {"value": ["mean", "min", "max", "sum"]}, prefix="pos_last_")
    trend = {k: ["sk_dpd", "sk_dpd_def"] for k in W.POS_TREND_PERIODS}
    lk = win.last_k(rows, key, ["ts"], W.POS_LAST_K_SPEC, W.POS_PERIODS, tiebreak=["event_id"], trend=trend)
    loan = win.latest_loan(rows, key, "event_type", ["ts", "event_id"], W.POS_LAST_LOAN_SPEC)
    return _on_spine(spark, d, [basic, last, lk, loan], key)


# ------------------------------------------------------------------ B35-B42: previous applications

PREV_AMT = ["amt_annuity", "amt_application", "amt_credit", "amt_down_payment", "amt_goods_price", "rate_down_payment", "cnt_payment"]
PREV_DAYS = ["days_first_due", "days_last_due_1st_version", "days_last_due", "days_termination", "days_decision"]
PREV_CATEGORIES = [
    "name_contract_type", "weekday_appr_process_start", "hour_appr_process_start", "name_cash_loan_purpose",
    "name_contract_status", "name_payment_type", "code_reject_reason", "name_type_suite", "name_client_type",
    "name_goods_category", "name_portfolio", "name_product_type", "channel_type", "name_seller_industry",
    "name_yield_group", "product_combination",
]
DAYS_SENTINEL = 365243


def previous_rows(spark: SparkSession, d: str) -> DataFrame:
    """Previous applications on orders: 7 amounts, 6 day offsets (sentinel -> NULL, P1), 16 categories."""
    o = fx.bureau(spark, d)
    n, price, days = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_days")
    canceled = F.col("o_orderstatus") == "P"

    def day(value):
        return X.null_if_equal(F.when(canceled, F.lit(DAYS_SENTINEL)).otherwise(value), DAYS_SENTINEL)

    def code(letter, m, shift=0):
        return F.concat(F.lit(letter), ((n + shift) % m).cast("string"))

    return o.select(
        F.col("o_custkey").alias("sk_id_curr"),
        n.alias("sk_id_prev"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Approved")).when(F.col("o_orderstatus") == "O", F.lit("Refused"))
        .otherwise(F.lit("Canceled")).alias("name_contract_status"),
        F.col("o_orderpriority").alias("name_contract_type"),
        price.alias("amt_credit"),
        (price * (F.lit(0.83) + (n % 7) / F.lit(17.0))).alias("amt_application"),
        (price / (F.lit(6) + n % 25)).alias("amt_annuity"),
        F.when(~canceled, price * (n % 10) / F.lit(100.0)).alias("amt_down_payment"),
        X.null_if_equal(price - price % 1000, 0).alias("amt_goods_price"),
        F.when(~canceled, (n % 10) / F.lit(100.0)).alias("rate_down_payment"),
        F.when(n % 11 != 0, (F.lit(12) + n % 48).cast("double")).alias("cnt_payment"),
        days.alias("days_decision"),
        (days + 30).alias("days_first_due"),
        day(days + 300 + n % 90).alias("days_last_due_1st_version"),
        day(days + 365).alias("days_last_due"),
        day(days + 370 + n % 60).alias("days_termination"),
        day(days + n % 20).alias("days_first_drawing"),
        F.dayofweek("o_orderdate").cast("string").alias("weekday_appr_process_start"),
        (n % 24).cast("string").alias("hour_appr_process_start"),
        F.when(n % 3 != 0, code("purpose ", 5)).alias("name_cash_loan_purpose"),
        code("pay ", 4, 1).alias("name_payment_type"),
        F.when(F.col("o_orderstatus") == "O", code("reason ", 3)).alias("code_reject_reason"),
        F.when(n % 7 != 0, code("suite ", 6, 2)).alias("name_type_suite"),
        F.when(n % 2 == 0, F.lit("Repeater")).otherwise(F.lit("New")).alias("name_client_type"),
        code("goods ", 9, 3).alias("name_goods_category"),
        code("portfolio ", 4, 5).alias("name_portfolio"),
        F.when(n % 5 == 0, F.lit("x-sell")).otherwise(F.lit("walk-in")).alias("name_product_type"),
        code("channel ", 8, 7).alias("channel_type"),
        code("industry ", 10, 1).alias("name_seller_industry"),
        F.when(price > 200000, F.lit("high")).when(price > 100000, F.lit("middle")).otherwise(F.lit("low")).alias("name_yield_group"),
        F.concat_ws(" ", F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)).alias("product_combination"),
    )


def previous_part(p: DataFrame, key: str = KEY) -> DataFrame:
    """B36-B40 in one aggregate: missing counts; amounts and days of all, approved and refused applications."""
    d0 = cols.cast_columns(p, PREV_AMT + PREV_DAYS, "double").select(
        "*",
        X.guarded_ratio("amt_credit", "amt_annuity").alias("amt_min_year"),
        X.diff("amt_credit", "amt_application").alias("amt_credit_trust"),
        X.guarded_ratio("amt_credit", "amt_application").alias("amt_credit_ratio"),
        X.guarded_ratio("amt_credit", "amt_goods_price").alias("amt_goods_ratio"),
        X.diff("amt_credit", "amt_goods_price").alias("amt_goods_remain"),
        X.diff("days_last_due", "days_first_due").alias("days_due_diff"),
        X.diff("days_last_due_1st_version", "days_last_due").alias("days_last_due_diff"),
        X.diff("days_first_due", "days_decision").alias("days_waiting_diff"),
        X.diff("days_last_due_1st_version", "days_first_due").alias("days_origin_due_diff"),
        X.diff("days_termination", "days_last_due").alias("days_origin_que_diff"),
    )
    namer = lambda pre, c, t, f: f"prev_{t + '_' if t else ''}{c}_{f}"
    amt, day = {c: FIVE for c in previous_amounts()}, {c: FIVE for c in previous_days()}
    slices = [agg.ALL, agg.eq_slice("approved", "name_contract_status", "Approved"), agg.eq_slice("refused", "name_contract_status", "Refused")]
    parts = [agg.Part(amt, slices, namer=namer), agg.Part(day, [slices[0], slices[2]], namer=namer), agg.Part({c: [*FIVE, "sum"] for c in day}, slices[1:2], namer=namer)]
    return agg.aggregate_parts(d0, key, parts, _missing(PREV_AMT + PREV_DAYS, "prev_"))


def previous_amounts() -> list[str]:
    return [*PREV_AMT, "amt_min_year", "amt_credit_trust", "amt_credit_ratio", "amt_goods_ratio", "amt_goods_remain"]


def previous_days() -> list[str]:
    return [*PREV_DAYS, "days_due_diff", "days_last_due_diff", "days_waiting_diff", "days_origin_due_diff", "days_origin_que_diff"]


def previous_block(spark: SparkSession, d: str, corr_threshold: float | None = 0.9, narrow: bool = True) -> DataFrame:
    """B35 (B36-B42): missing counts, all/approved/refused statistics, category counts, last-k contracts."""
    p = previous_rows(spark, d)
    key = KEY
    stats = _without_empty(written(previous_part(p), "previous"))
    # B38, B39 twice, B40 twice; the amounts of all applications (B37) are not pruned
    scopes = [("prev_", previous_days(), FIVE)]
    for status, day_fns in (("approved", [*FIVE, "sum"]), ("refused", FIVE)):
        scopes += [(f"prev_{status}_", previous_amounts(), FIVE), (f"prev_{status}_", previous_days(), day_fns)]
    for prefix, columns, fns in scopes:
        stats = _prune(stats, key, corr_threshold, [f"{prefix}{c}_{f}" for c in columns for f in fns])
    cats = agg.category_counts_many(p, key, PREV_CATEGORIES, lambda c, v: f"prev_{c}_{agg.sanitize(v)}")  # B41
    term = {"cnt_payment": "term_of", "days_decision": "days_decision_about", "days_first_drawing": "days_first_drawing"}
    lastk = win.last_k(
        p, key, ["days_decision", "sk_id_prev"], {c: ["mean"] for c in term}, [1, 3, 5],
        namer=lambda k, c, f: f"previous_application_{term[c]}_last_{k}_credits_{f}",
    )  # B42
    lastk = _prune(_written_if(lastk, corr_threshold, "previous-last-k"), key, corr_threshold)
    block = _prune(_written_if(_on_spine(spark, d, [stats, cats, lastk]), corr_threshold, "previous"), key, corr_threshold)
    if narrow:  # P31 (reduce_mem_usage): the output types depend on the data's ranges
        block = cols.narrow_types(block, exclude=[key])
    return block.withColumnRenamed(key, "c_custkey")


# ------------------------------------------------------------------ B14-B21: card balance

CARD_SIX = ["mean", "min", "max", "median", "sum", "std"]
CARD_YEAR_COLUMNS = [
    "amt_balance", "amt_credit_limit_actual", "amt_drawings_current", "amt_payment_current", "amt_receivable_principal",
    "cnt_drawings_current", "sk_dpd", "sk_dpd_def", "amt_balance_ratio",
]


def card_rows(spark: SparkSession, d: str) -> DataFrame:
    """Card-like monthly rows on events: loan = (user, event type); one day of events plays one month."""
    from loomfeat.plans import q_win as W

    r = W.pos_rows(spark, d)
    n = F.col("event_id")
    return r.select(
        F.col("user_id").alias("sk_id_curr"),
        F.col("event_type").alias("sk_id_prev"),
        "ts", "event_id",
        F.col("e_days").alias("months_balance"),
        F.when(n % 4 == 0, F.lit("Completed")).otherwise(F.lit("Active")).alias("name_contract_status"),
        F.when(n % 9 == 0, F.lit(0.0)).otherwise(F.col("value")).alias("amt_balance"),
        (F.col("value") * 2 + n % 13).alias("amt_credit_limit_actual"),
        X.null_if(F.col("value") - 5, F.col("value") < 5).alias("amt_drawings_current"),
        (F.col("value") * ((n % 5) / F.lit(8.0))).alias("amt_payment_current"),
        F.when(F.col("event_type") == "purchase", F.col("value")).when(n % 17 == 0, F.lit(None)).otherwise(F.lit(0.0)).alias("amt_payment_total_current"),
        (F.col("value") * F.lit(0.75) + n % 6).alias("amt_receivable_principal"),
        (F.col("value") + n % 10).alias("amt_recivable"),
        F.col("sk_dpd").alias("cnt_drawings_current"),
        "sk_dpd", "sk_dpd_def",
    )


def card_derived(c: DataFrame) -> DataFrame:
    """The six derived columns of B18 and B19: three differences, three guarded ratios."""
    return c.select(
        "*",
        X.diff("amt_recivable", "amt_receivable_principal").alias("amt_receivable_diff"),
        X.diff("amt_credit_limit_actual", "amt_balance").alias("amt_balance_diff"),
        X.diff("amt_credit_limit_actual", "amt_drawings_current").alias("amt_drawings_diff"),
        X.guarded_ratio("amt_drawings_current", "amt_credit_limit_actual").alias("amt_credit_ratio"),
        X.guarded_ratio("amt_balance", "amt_credit_limit_actual").alias("amt_balance_ratio"),
        X.guarded_ratio("amt_recivable", "amt_balance").alias("amt_receivable_ratio"),
    )


def card_block(spark: SparkSession, d: str, corr_threshold: float | None = 0.9) -> DataFrame:
    """B14 (B15-B21): missing, overdue, usage, all, with-payment, last one and two years."""
    c = card_derived(card_rows(spark, d))
    key, loan = KEY, "sk_id_prev"
    derived = ["amt_receivable_diff", "amt_balance_diff", "amt_drawings_diff", "amt_credit_ratio", "amt_balance_ratio", "amt_receivable_ratio"]
    amt = [x for x in cols.by_pattern(c, "amt_") if x not in derived]
    cnt = cols.by_pattern(c, "cnt_")
    # B15 (Q3: count rows), B16 and the use flag of B17: one aggregate per entity
    c = c.select(
        "*",
        (F.col("sk_dpd") - F.col("sk_dpd_def")).cast("double").alias("sk_out"),
        X.flag_gt(F.col("sk_dpd") - F.col("sk_dpd_def"), 0).alias("out_overdue_flag"),
        X.flag_gt("amt_balance", 0).alias("using_flag"),
    )
    days = cols.cast_columns(c, ["sk_dpd", "sk_dpd_def"], "double")
    flags = {"out_overdue_flag": ["mean", "sum", "count"], "using_flag": ["mean", "sum", "count"]}
    overdue = {x: ["median", "mean", "sum", "max", "std"] for x in ["sk_out", "sk_dpd_def", "sk_dpd"]}
    part = agg.aggregate_parts(days, key, [agg.Part(flags, prefix="card_"), agg.Part(overdue)], _missing(["months_balance", *amt, *cnt, "sk_dpd", "sk_dpd_def"], "creditcard_"))
    part = _without_empty(written(part, "card"))
    for scope in ([f"card_out_overdue_flag_{f}" for f in flags["out_overdue_flag"]], [f"{x}_{f}" for x, fns in overdue.items() for f in fns], [f"card_using_flag_{f}" for f in flags["using_flag"]]):
        part = _prune(part, key, corr_threshold, scope)
    # The distinct payments of each loan (a missing payment is not equal to 0, and is one of them)
    payment = "amt_payment_total_current"
    paid = ~F.coalesce(F.col(payment) == 0, F.lit(False))
    payments = c.where(paid).groupBy(key, loan, payment).agg(F.count(F.lit(1)).alias("__n"))
    first = agg.two_level(payments, key, loan, {payment: ["max", "min", "median", "mean", "sum", "std"]}, ["mean", "min", "max", "sum", "std", "median"], prefix="card_first_time_")
    first = _prune(_written_if(first, corr_threshold, "card-payments"), key, corr_threshold)
    # Level 1 of all four row sets in one aggregate, written once; level 2 of what its pruning leaves in one more
    active = "`name_contract_status` = 'Active'"
    sets = {
        "all": (agg.Slice("all"), [*amt, *cnt, *derived], True),
        "using": (agg.Slice("using", paid, f"NOT coalesce(`{payment}` = 0, false)"), [*amt, *cnt, *derived], True),
        "2_year": (agg.Slice("2_year", F.expr(f"`months_balance` >= -24 AND {active}"), f"(`months_balance` >= -24 AND {active})"), CARD_YEAR_COLUMNS, False),
        "1_year": (agg.Slice("1_year", F.expr(f"`months_balance` >= -12 AND {active}"), f"(`months_balance` >= -12 AND {active})"), CARD_YEAR_COLUMNS, False),
    }
    inner = lambda p, x, t, f: f"{t}__{x}_{f}"
    parts = [agg.Part({x: CARD_SIX for x in feats}, [s], namer=inner) for s, feats, _ in sets.values()]
    # NULL for a loan without a row in a set: its statistics are not there, rather than 0
    lvl1 = written(agg.aggregate_parts(c, [key, loan], parts, [F.count_if(s.where if s.where is not None else F.lit(True)).alias(f"rows_in_{t}") for t, (s, _, _) in sets.items()]), "card-loans")
    outer = []
    for tag, (_, feats, prune) in sets.items():
        names = [f"{tag}__{x}_{f}" for x in feats for f in CARD_SIX]
        if prune and corr_threshold is not None:
            kept, _ = select.correlation_prune(lvl1.where(F.col(f"rows_in_{tag}") > 0).select(*names), corr_threshold)
            names = kept.columns
        here = agg.Slice(tag, F.col(f"rows_in_{tag}") > 0, f"`rows_in_{tag}` > 0")
        outer.append(agg.Part({x: CARD_SIX for x in names}, [here], namer=lambda p, x, t, f: f"card_{x.replace('__', '_', 1)}_{f}"))
    lvl2 = _written_if(agg.aggregate_parts(lvl1, key, outer), corr_threshold, "card-entities")
    for tag, (_, _, with_key) in sets.items():
        lvl2 = _prune(lvl2, key if with_key else None, corr_threshold, [x for x in lvl2.columns if x.startswith(f"card_{tag}_")])
    # the payments and loans of an entity are among its rows, which ``part`` counts
    block = _on_spine(spark, d, [part, first, lvl2], validate=False, known=part)
    return _prune(_written_if(block, corr_threshold, "card"), key, corr_threshold)


# ------------------------------------------------------------------ B52: modular main


def modular_main(spark: SparkSession, d: str, corr_threshold: float | None = 0.9) -> DataFrame:
    """The split application table with WOE and its features, then every child block joined on.

    Each block is written as Parquet below the shared checkpoint folder, narrowed by the
    ranges of its written columns (P31, one pass), and joined one to one: the
    long lineage is cut, a lost executor only recomputes its own block, and each block is
    planned, shuffled and spilled on its own.
    """
    app = application_frame(spark, d)
    test = F.col("c_custkey") % 5 == 0  # these customers play the submission rows
    main, _, _ = load_split(app.where(~test), app.where(test), "c_custkey", "target")
    main = woe_block(main, app.where(~test), cols.string_columns(app), "target")
    main = application_features(main.drop(*cols.string_columns(app)))
    parts = {
        "bureau": bureau_block(spark, d, corr_threshold),
        "balance": balance_block(spark, d, corr_threshold),
        "card": card_block(spark, d, corr_threshold).withColumnRenamed("sk_id_curr", "c_custkey"),
        "instalment": instalment_block(spark, d, corr_threshold),
        "pos": pos_block(spark, d, corr_threshold).withColumnRenamed("user_id", "c_custkey"),
        "previous": previous_block(spark, d, corr_threshold, narrow=False),
    }
    wide = main = cols.write_narrowed(main, "block-application", exclude=["c_custkey"])
    for name, frame in parts.items():
        block = cols.write_narrowed(frame, f"block-{name}", exclude=["c_custkey"])
        block = joins.dedupe_columns(wide, block, "c_custkey", suffix="_dup")
        wide = joins.validated_left_join(wide, block, "c_custkey", spine_checked=wide is not main)
    return wide
