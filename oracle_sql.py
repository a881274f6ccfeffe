"""DuckDB oracle SQL for every query of ``loomfeat.plans.catalog``.

The SQL is written in the reference's own, naive shape (one filtered
subquery per slice, joined back), independent of the fused Spark plans it
checks. Double results are compared as REAL (see ``loomfeat.canon``).
Tables are the driver's pre-registered views.
"""

from __future__ import annotations

# Fixed values shared with loomfeat.sources.fixtures (reference dates of the mapping).
ORDERS_REF = "DATE '2001-08-02'"
INSTALMENT_REF = "DATE '2001-11-05'"
EVENTS_REF = "DATE '2024-01-31'"

CTE = {
    "o": f"o AS (SELECT *, CAST(CAST(o_orderdate AS DATE) - {ORDERS_REF} AS INTEGER) AS o_days FROM orders)",
    "c": "c AS (SELECT *, CAST(c_acctbal < 0 AS INTEGER) AS target FROM customer)",
    "ins": (
        "ins AS (SELECT o.o_custkey, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, "
        "CAST(CAST(l.l_quantity AS INTEGER) % 4 AS INTEGER) AS i_version, "
        "l.l_extendedprice AS i_due, "
        "l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) AS i_paid, "
        f"CAST(CAST(o.o_orderdate AS DATE) - {INSTALMENT_REF} + 60 AS INTEGER) AS i_days_due, "
        f"CAST(CAST(l.l_shipdate AS DATE) - {INSTALMENT_REF} AS INTEGER) AS i_days_paid "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"
    ),
    "e": f"e AS (SELECT *, CAST(CAST(ts AS DATE) - {EVENTS_REF} AS INTEGER) AS e_days FROM events)",
    "docs": (
        "docs AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
    ),
}


RAW = False  # True while generating an intermediate CTE that must stay in double


def with_(*names: str) -> str:
    return "WITH " + ", ".join(CTE[n] for n in names) + " "


def f32(e: str) -> str:
    """Double result in canonical form."""
    if RAW:
        return f"CAST({e} AS DOUBLE)"
    return f"CAST(CASE WHEN abs({e}) < 1e-9 THEN 0 ELSE ({e}) END AS REAL)"


# ------------------------------------------------------------- aggregates

DOUBLE_FNS = {"mean", "std", "var", "median", "nonzero", "skew", "kurt", "iqr"}
COUNT_FNS = {"count", "size", "nunique"}


def agg_sql(fn: str, x: str) -> str:
    """Reference semantics of one aggregate over the rows of a (filtered) group."""
    return {
        "min": f"min({x})",
        "max": f"max({x})",
        "mean": f"avg({x})",
        "sum": f"coalesce(sum({x}), 0)",
        "std": f"stddev_samp({x})",
        "var": f"var_samp({x})",
        "median": f"median({x})",
        "count": f"count({x})",
        "size": "count(*)",
        "nunique": f"count(DISTINCT {x})",
        "nonzero": f"avg(CASE WHEN {x} IS DISTINCT FROM 0 THEN 1 ELSE 0 END)",
        "iqr": f"CASE WHEN count({x}) = count(*) THEN quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) END",
    }[fn]


def typed(fn: str, expr: str, src_type: str) -> str:
    """Cast an aggregate to the type Spark produces for it."""
    if fn in COUNT_FNS:
        return f"CAST({expr} AS BIGINT)"
    if fn in DOUBLE_FNS or src_type == "double":
        return f32(expr)
    if fn == "sum":
        return f"CAST({expr} AS BIGINT)"
    return f"CAST({expr} AS {'INTEGER' if src_type == 'int' else 'BIGINT'})"


def spec_select(spec: dict, types: dict, prefix: str, tag: str) -> list[str]:
    out = []
    for c, fns in spec.items():
        for fn in fns:
            name = f"{prefix}{c}{'_' + tag if tag else ''}_{fn}"
            out.append((name, typed(fn, agg_sql(fn, c), types[c])))
    return out


def naive_sliced(table: str, key: str, spec: dict, types: dict, slices: list, prefix: str, spine: str, spine_key: str, fill: bool) -> str:
    """Spine LEFT JOIN one aggregate subquery per slice (the reference's shape)."""
    subs, cols = [], []
    for i, (tag, where) in enumerate(slices):
        sel = spec_select(spec, types, prefix, tag)
        body = ", ".join(f"{e} AS {n}" for n, e in sel)
        w = f" WHERE {where}" if where else ""
        subs.append(f"LEFT JOIN (SELECT {key} AS k{i}, {body} FROM {table}{w} GROUP BY {key}) s{i} ON sp.{spine_key} = s{i}.k{i}")
        for n, _ in sel:
            cols.append(f"coalesce(s{i}.{n}, 0) AS {n}" if fill else f"s{i}.{n}")
    return f"SELECT sp.{spine_key}, {', '.join(cols)} FROM {spine} sp " + " ".join(subs)


# ------------------------------------------------------------- queries

FLAGSHIP_SPEC = {
    "o_totalprice": ["min", "max", "mean", "sum", "std", "size"],
    "o_days": ["min", "max", "mean"],
}
FLAGSHIP_TYPES = {"o_totalprice": "double", "o_days": "int"}


def _flagship_slices():
    status = [("fin", "o_orderstatus = 'F'"), ("opn", "o_orderstatus = 'O'")]
    windows = [("1y", "o_days >= -365"), ("2y", "o_days >= -730")]
    out = [("", None), *windows]
    for t, w in status:
        out.append((t, w))
        out.extend((f"{t}_{wt}", f"{w} AND {ww}") for wt, ww in windows)
    return out


def q_flagship() -> str:
    return with_("o") + naive_sliced(
        "o", "o_custkey", FLAGSHIP_SPEC, FLAGSHIP_TYPES, _flagship_slices(), "ord_", "customer", "c_custkey", True
    )



def filt(w):
    return f" FILTER (WHERE {w})" if w else ""


def moment_sql(fn: str, x: str, mu: str, w: str | None = None) -> str:
    """Population skewness / excess kurtosis (Spark's definitions), constant group -> NULL."""
    f = filt(w)
    m2 = f"sum(pow({x} - {mu}, 2)){f}"
    guard = f"count({x}){f} = count(*){f} AND min({x}){f} <> max({x}){f}"
    if fn == "skew":
        return f"CASE WHEN {guard} THEN sqrt(count({x}){f}) * sum(pow({x} - {mu}, 3)){f} / pow({m2}, 1.5) END"
    return f"CASE WHEN {guard} THEN count({x}){f} * sum(pow({x} - {mu}, 4)){f} / pow({m2}, 2) - 3 END"


def q_functions() -> str:
    x = "l_quantity"
    sel = ["l_suppkey"]
    for fn in ["min", "max", "mean", "sum", "std", "var", "median", "count", "size", "nunique"]:
        sel.append(f"{typed(fn, agg_sql(fn, x), 'double')} AS li_l_quantity_{fn}")
    sel.append(f"{f32(moment_sql('skew', x, 'mu'))} AS li_l_quantity_skew")
    sel.append(f"{f32(moment_sql('kurt', x, 'mu'))} AS li_l_quantity_kurt")
    sel.append(f"{f32(agg_sql('iqr', x))} AS li_l_quantity_iqr")
    for fn in ["nonzero", "mean", "max"]:
        sel.append(f"{typed(fn, agg_sql(fn, 'l_discount'), 'double')} AS li_l_discount_{fn}")
    return (
        "WITH t AS (SELECT *, avg(l_quantity) OVER (PARTITION BY l_suppkey) AS mu FROM lineitem) "
        f"SELECT {', '.join(sel)} FROM t GROUP BY l_suppkey"
    )


def q_first_valid() -> str:
    return with_("o") + (
        ", v AS (SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM o), "
        "r AS (SELECT o_custkey, price, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn "
        "FROM v WHERE price IS NOT NULL) "
        f"SELECT k.o_custkey, {f32('r.price')} AS last_valid_price FROM (SELECT DISTINCT o_custkey FROM o) k "
        "LEFT JOIN r ON k.o_custkey = r.o_custkey AND r.rn = 1"
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def san(v: str) -> str:
    out = "".join(ch.lower() if ch.isalnum() else "_" for ch in v)
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_")


def q_share() -> str:
    parts, cols = [], []
    for i, (tag, w) in enumerate([("", None), ("opn", "o_orderstatus = 'O'")]):
        body = ", ".join(
            f"{f32(f'avg(CASE WHEN o_orderpriority = {chr(39)}{v}{chr(39)} THEN 1 ELSE 0 END)')} AS ord_o_orderpriority{'_' + tag if tag else ''}_share_{san(v)}"
            for v in PRIORITIES
        )
        where = f" WHERE {w}" if w else ""
        parts.append(f"LEFT JOIN (SELECT o_custkey AS k, {body} FROM orders{where} GROUP BY o_custkey) s{i} ON sp.o_custkey = s{i}.k")
        cols += [f"s{i}.ord_o_orderpriority{'_' + tag if tag else ''}_share_{san(v)}" for v in PRIORITIES]
    return f"SELECT sp.o_custkey, {', '.join(cols)} FROM (SELECT DISTINCT o_custkey FROM orders) sp " + " ".join(parts)


def q_category_slices() -> str:
    slices = [(san(v), f"o_orderpriority = '{v}'") for v in PRIORITIES]
    spec = {"o_totalprice": ["mean", "max", "size"], "o_days": ["min"]}
    return with_("o") + naive_sliced(
        "o", "o_custkey", spec, FLAGSHIP_TYPES, slices, "pri_", "(SELECT DISTINCT o_custkey FROM orders)", "o_custkey", False
    )


BB = "bb AS (SELECT l_orderkey, l_returnflag, count(*) AS months FROM lineitem GROUP BY l_orderkey, l_returnflag)"
ROWS = (
    "rows AS (SELECT o.o_custkey, o.o_orderkey, bb.l_returnflag, "
    "CASE WHEN bb.l_returnflag IN ('R') THEN 1.0 ELSE 0.0 END AS overdue "
    "FROM orders o LEFT JOIN bb ON o.o_orderkey = bb.l_orderkey)"
)


def q_two_level() -> str:
    sel = []
    for c in ["overdue_mean", "overdue_sum"]:
        for fn in ["mean", "max", "std", "sum", "median"]:
            sel.append(f"{typed(fn, agg_sql(fn, c), 'double')} AS bureau_{c}_{fn}")
    return (
        f"WITH {BB}, {ROWS}, l1 AS (SELECT o_custkey, o_orderkey, avg(overdue) AS overdue_mean, "
        "coalesce(sum(overdue), 0) AS overdue_sum FROM rows GROUP BY o_custkey, o_orderkey) "
        f"SELECT o_custkey, {', '.join(sel)} FROM l1 GROUP BY o_custkey"
    )


def q_missing() -> str:
    def cnt(pred, name):
        return f"CAST(CASE WHEN count_if({pred}) > 0 THEN count_if({pred}) END AS BIGINT) AS {name}"

    return (
        "SELECT o_custkey, "
        + cnt("o_orderstatus = 'P'", "credit_o_orderstatus_miss_times")
        + ", "
        + cnt("o_totalprice > 450000", "credit_o_totalprice_miss_times")
        + " FROM orders GROUP BY o_custkey"
    )


AMOUNTS = (
    "b AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, "
    f"CAST(CAST(o_orderdate AS DATE) - {ORDERS_REF} AS INTEGER) AS o_days, "
    "o_totalprice AS amt_credit, "
    "CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END AS amt_debt, "
    "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0.0 END AS amt_overdue FROM orders)"
)


def q_totals() -> str:
    return (
        f"WITH {AMOUNTS}, t AS (SELECT o_custkey, sum(amt_debt) AS d, sum(amt_credit) AS c, sum(amt_overdue) AS v FROM b GROUP BY o_custkey) "
        f"SELECT o_custkey, {f32('d')} AS bureau_total_customer_debt, {f32('c')} AS bureau_total_customer_credit, "
        f"{f32('v')} AS bureau_total_customer_overdue, {f32('d / nullif(1 + c, 0)')} AS bureau_debt_credit_ratio, "
        f"{f32('v / nullif(1 + d, 0)')} AS bureau_overdue_debt_ratio FROM t"
    )


def q_category_counts() -> str:
    def cnt(col, v, name):
        return f"CAST(CASE WHEN count_if({col} = '{v}') > 0 THEN count_if({col} = '{v}') END AS BIGINT) AS {name}"

    cols = [cnt("o_orderpriority", v, f"prev_o_orderpriority_{san(v)}") for v in PRIORITIES]
    cols += [cnt("o_orderstatus", v, f"prev_o_orderstatus_{v.lower()}") for v in ["F", "O", "P"]]
    return f"SELECT o_custkey, {', '.join(cols)} FROM orders GROUP BY o_custkey"


def q_status_rates() -> str:
    flags = ["A", "N", "R"]
    cols = [f"CAST(count_if(l_returnflag = '{v}') AS BIGINT) AS balance_l_returnflag_{v.lower()}" for v in flags]
    cols.append("CAST(count(*) AS BIGINT) AS status_total")
    cols += [f"{f32(f'count_if(l_returnflag = {chr(39)}{v}{chr(39)}) / count(*)')} AS balance_l_returnflag_{v.lower()}_rate" for v in flags]
    return f"WITH {BB}, {ROWS} SELECT o_custkey, {', '.join(cols)} FROM rows WHERE l_returnflag IS NOT NULL GROUP BY o_custkey"


def q_latest_period() -> str:
    return with_("e") + (
        ", l1 AS (SELECT user_id, e_days, avg(value) AS m, min(value) AS lo, max(value) AS hi, sum(value) AS s FROM e GROUP BY user_id, e_days), "
        "r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY e_days DESC) AS rn FROM l1) "
        f"SELECT user_id, e_days AS pos_last_e_days, {f32('m')} AS pos_last_value_mean, {f32('lo')} AS pos_last_value_min, "
        f"{f32('hi')} AS pos_last_value_max, {f32('s')} AS pos_last_value_sum FROM r WHERE rn = 1"
    )


def q_flag_stats() -> str:
    flags = (
        "f AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS active_flag, "
        "CASE WHEN o_days > -365 THEN 1 ELSE 0 END AS enddate_flag, "
        "CASE WHEN amt_overdue > 0 THEN 1 ELSE 0 END AS overdue_flag, "
        "CASE WHEN amt_debt > 0 THEN 1 ELSE 0 END AS using_flag FROM b)"
    )
    cols = []
    for c in ["active_flag", "enddate_flag", "overdue_flag", "using_flag"]:
        cols += [f"{f32(f'avg({c})')} AS credit_{c}_mean", f"CAST(sum({c}) AS BIGINT) AS credit_{c}_sum", f"count({c}) AS credit_{c}_count"]
    return f"WITH {AMOUNTS}, {flags} SELECT o_custkey, {', '.join(cols)} FROM f GROUP BY o_custkey"


def q_global() -> str:
    cols = []
    for c in ["l_quantity", "l_extendedprice"]:
        cols += [
            f"{f32(f'min({c})')} AS {c}_min", f"{f32(f'max({c})')} AS {c}_max", f"{f32(f'median({c})')} AS {c}_median",
            f"{f32(f'avg({c})')} AS {c}_mean", f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}_nulls",
            f"count(DISTINCT {c}) AS {c}_nunique",
        ]
    return f"SELECT {', '.join(cols)} FROM lineitem"


def q_validated() -> str:
    return with_("o") + (
        f"SELECT o_custkey, {f32('sum(o_totalprice)')} AS v_o_totalprice_sum, count(*) AS v_o_totalprice_size, "
        "max(o_days) AS v_o_days_max FROM o GROUP BY o_custkey"
    )


def q_label() -> str:
    return (
        "SELECT o.o_orderkey, o.o_custkey AS c_custkey, CAST(c.c_acctbal < 0 AS INTEGER) AS target "
        "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"
    )


def q_collision() -> str:
    return (
        f"SELECT a.o_custkey, {f32('a.m')} AS x_o_totalprice_mean, {f32('b.m')} AS x_o_totalprice_mean_y FROM "
        "(SELECT o_custkey, avg(o_totalprice) AS m FROM orders GROUP BY o_custkey) a LEFT JOIN "
        "(SELECT o_custkey, avg(o_totalprice) AS m FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) b "
        "ON a.o_custkey = b.o_custkey"
    )



# ------------------------------------------------------------- windows

def fagg(fn: str, x: str, w: str | None, mu: str | None = None, src: str = "double") -> str:
    """One aggregate over the rows of a FILTER slice, with the slice guards."""
    f = filt(w)
    n = f"count(*){f}"
    e = {
        "min": f"min({x}){f}",
        "max": f"max({x}){f}",
        "mean": f"avg({x}){f}",
        "sum": f"CASE WHEN {n} > 0 THEN coalesce(sum({x}){f}, 0) END",
        "std": f"stddev_samp({x}){f}",
        "var": f"var_samp({x}){f}",
        "median": f"median({x}){f}",
        "count": f"CASE WHEN {n} > 0 THEN count({x}){f} END",
        "size": f"CASE WHEN {n} > 0 THEN {n} END",
        "nunique": f"CASE WHEN {n} > 0 THEN count(DISTINCT {x}){f} END",
        "nonzero": f"avg(CASE WHEN {x} IS DISTINCT FROM 0 THEN 1 ELSE 0 END){f}",
        "iqr": f"CASE WHEN count({x}){f} = {n} THEN quantile_cont({x}, 0.75){f} - quantile_cont({x}, 0.25){f} END",
    }.get(fn)
    if fn in ("skew", "kurt"):
        e = moment_sql(fn, x, mu, w)
    return typed(fn, e, src)


def trend_sql(y: str, xpos: str, w: str) -> str:
    f = filt(w)
    n = f"count(*){f}"
    return f32(
        f"CASE WHEN {n} = 0 THEN NULL WHEN count({y}){f} < {n} THEN NULL WHEN {n} = 1 THEN 0 "
        f"ELSE regr_slope({y}, {xpos}){f} END"
    )


NINE = ["sum", "mean", "max", "min", "std", "median", "skew", "kurt", "iqr"]
INS_SPEC = {"i_version": NINE, "late_days": NINE, "paid_late": ["count", "mean"], "over_amount": NINE, "paid_over": ["count", "mean"]}
INS_TYPES = {"i_version": "int", "late_days": "int", "paid_late": "int", "over_amount": "double", "paid_over": "int"}
INS_K = [1, 5, 10, 20, 50, 100]
INS_ROWS = (
    CTE["ins"] + ", i AS (SELECT *, i_days_paid - i_days_due AS late_days, "
    "CASE WHEN i_days_paid - i_days_due > 0 THEN 1 ELSE 0 END AS paid_late, "
    "i_paid - i_due AS over_amount, CASE WHEN i_paid - i_due > 0 THEN 1 ELSE 0 END AS paid_over FROM ins)"
)
INS_RANK = (
    "r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY i_days_due DESC, l_orderkey, l_linenumber, "
    "l_partkey, l_suppkey, i_version, i_due, i_paid, i_days_paid) AS rn FROM i)"
)


def last_k_sql(table_rank: str, key: str, spec: dict, types: dict, ks: list, moment_cols: list, namer) -> str:
    mus = [f"avg({c}) FILTER (WHERE rn <= {k}) OVER (PARTITION BY {key}) AS mu_{c}_{k}" for k in ks for c in moment_cols]
    sel = [key]
    for k in ks:
        for c, fns in spec.items():
            for fn in fns:
                sel.append(f"{fagg(fn, c, f'rn <= {k}', f'mu_{c}_{k}', types[c])} AS {namer(k, c, fn)}")
    mu_cte = f", m AS (SELECT *{', ' if mus else ''}{', '.join(mus)} FROM {table_rank})"
    return mu_cte, f"SELECT {', '.join(sel)} FROM m GROUP BY {key}"


def q_last_k() -> str:
    mu_cte, body = last_k_sql("r", "o_custkey", INS_SPEC, INS_TYPES, INS_K, ["i_version", "late_days", "over_amount"], lambda k, c, f: f"last_{k}_{c}_{f}")
    return f"WITH {INS_ROWS}, {INS_RANK}{mu_cte} {body}"


def q_fractions() -> str:
    global RAW
    RAW = True
    try:
        mu_cte, body = last_k_sql("r", "o_custkey", INS_SPEC, INS_TYPES, INS_K, ["i_version", "late_days", "over_amount"], lambda k, c, f: f"last_{k}_{c}_{f}")
    finally:
        RAW = False
    sel = ["o_custkey"]
    for s_, l_ in [(5, 20), (5, 50), (10, 100)]:
        for c, fns in INS_SPEC.items():
            for fn in fns:
                a, b = f"CAST(last_{s_}_{c}_{fn} AS DOUBLE)", f"CAST(last_{l_}_{c}_{fn} AS DOUBLE)"
                sel.append(f"{f32(f'CASE WHEN abs({b}) < 1e-9 THEN 0.0 ELSE {a} / {b} END')} AS last_{s_}by{l_}_fraction_{c}_{fn}")
    return f"WITH {INS_ROWS}, {INS_RANK}{mu_cte}, lk AS ({body}) SELECT {', '.join(sel)} FROM lk"


def q_trend_ins() -> str:
    sel = ["o_custkey"]
    for k in [10, 50, 100, 500]:
        for c in ["late_days", "over_amount"]:
            sel.append(f"{trend_sql(c, 'rn - 1', f'rn <= {k}')} AS trend_{k}_{c}")
    return f"WITH {INS_ROWS}, {INS_RANK} SELECT {', '.join(sel)} FROM r GROUP BY o_custkey"


POS_ROWS = (
    CTE["e"] + ", p0 AS (SELECT *, CAST(floor(value / 10) AS INTEGER) AS sk_dpd FROM e), "
    "p AS (SELECT *, CASE WHEN event_type = 'error' THEN sk_dpd ELSE 0 END AS sk_dpd_def, "
    "CASE WHEN sk_dpd > 0 THEN 1 ELSE 0 END AS pos_paid_late, "
    "CASE WHEN (CASE WHEN event_type = 'error' THEN sk_dpd ELSE 0 END) > 0 THEN 1 ELSE 0 END AS pos_paid_late_tol FROM p0)"
)
POS_RANK = "r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM p)"
POS_SPEC = {
    "pos_paid_late": ["count", "mean"], "pos_paid_late_tol": ["count", "mean"],
    "sk_dpd": ["sum", "mean", "max", "min", "median"], "sk_dpd_def": ["sum", "mean", "max", "min", "median"],
}
POS_TYPES = {"pos_paid_late": "int", "pos_paid_late_tol": "int", "sk_dpd": "int", "sk_dpd_def": "int"}


def q_pos_last_k() -> str:
    sel = ["user_id"]
    for k in [1, 10, 50, None]:
        w = None if k is None else f"rn <= {k}"
        for c, fns in POS_SPEC.items():
            for fn in fns:
                name = f"all_{c}_{fn}" if k is None else f"last_{k}_{c}_{fn}"
                sel.append(f"{fagg(fn, c, w, None, POS_TYPES[c])} AS {name}")
    return f"WITH {POS_ROWS}, {POS_RANK} SELECT {', '.join(sel)} FROM r GROUP BY user_id"


def q_trend_pos() -> str:
    sel = ["user_id"]
    for k in [1, 6, 12, 30, 60]:
        for c in ["sk_dpd", "sk_dpd_def"]:
            sel.append(f"{trend_sql(c, 'rn - 1', f'rn <= {k}')} AS trend_{k}_{c}")
    return f"WITH {POS_ROWS}, {POS_RANK} SELECT {', '.join(sel)} FROM r GROUP BY user_id"


def q_latest_loan() -> str:
    spec = {
        "pos_paid_late": ["count", "sum", "mean"], "pos_paid_late_tol": ["sum", "mean"],
        "sk_dpd": ["sum", "mean", "max", "min", "std"], "sk_dpd_def": ["sum", "mean", "max", "min", "std"],
    }
    sel = ["r.user_id"]
    for c, fns in spec.items():
        for fn in fns:
            sel.append(f"{fagg(fn, c, None, None, POS_TYPES[c])} AS last_loan_{c}_{fn}")
    return (
        f"WITH {POS_ROWS}, {POS_RANK.replace('ts DESC, event_id', 'ts DESC, event_id DESC')}, "
        "newest AS (SELECT user_id, event_type FROM r WHERE rn = 1), "
        "rows AS (SELECT p.* FROM p JOIN newest n ON p.user_id = n.user_id AND p.event_type = n.event_type) "
        f"SELECT {', '.join(sel).replace('r.user_id', 'user_id')} FROM rows GROUP BY user_id"
    )


def q_tail_k() -> str:
    sel = ["o_custkey"]
    for k in [1, 3, 5]:
        for c in ["o_totalprice", "o_days", "urgent"]:
            sel.append(f"coalesce({f32(f'avg({c}) FILTER (WHERE rn <= {k})')}, 0) AS prev_last_{k}_{c}_mean")
    return with_("o") + (
        ", r AS (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent, "
        "ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_days DESC, o_orderkey DESC) AS rn FROM o) "
        f"SELECT {', '.join(sel)} FROM r GROUP BY o_custkey"
    )


DEDUP_FIRST = (
    "d AS (SELECT o_custkey, l_orderkey, i_version, l_linenumber, i_paid FROM ("
    "SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, l_orderkey, i_version ORDER BY l_linenumber, i_paid) AS rn0 FROM i) WHERE rn0 = 1)"
)


def q_dedup_first() -> str:
    return f"WITH {INS_ROWS}, {DEDUP_FIRST} SELECT o_custkey, l_orderkey, i_version, l_linenumber, {f32('i_paid')} AS i_paid FROM d"


def q_prolongation() -> str:
    fns = ["mean", "sum", "min", "median", "max", "std"]
    sel = ["o_custkey"]
    for c in ["pay_long", "pay_long_amount"]:
        for fn in fns:
            sel.append(f"{typed(fn, agg_sql(fn, c), 'double')} AS ins_{c}_{fn}")
    return (
        f"WITH {INS_ROWS}, {DEDUP_FIRST}, "
        "n AS (SELECT *, CAST(coalesce(LEAD(l_linenumber) OVER (PARTITION BY o_custkey, l_orderkey ORDER BY l_linenumber, i_version, i_paid) "
        "- l_linenumber, 1) AS DOUBLE) AS pay_long FROM d), "
        "q AS (SELECT o_custkey, pay_long, i_paid * pay_long AS pay_long_amount FROM n) "
        f"SELECT {', '.join(sel)} FROM q GROUP BY o_custkey"
    )


def q_dedup_last() -> str:
    return (
        f"WITH {POS_ROWS}, z AS (SELECT user_id, event_type, ts, event_id, value FROM p WHERE sk_dpd <> 0), "
        "l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC, value DESC) AS rn FROM z) "
        f"SELECT user_id, event_type, event_id, {f32('value')} AS value FROM l WHERE rn = 1"
    )


def q_lag() -> str:
    return (
        f"WITH {POS_ROWS}, g AS (SELECT *, LAG(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS pv FROM p) "
        f"SELECT event_id, user_id, {f32('coalesce(pv, value)')} AS prev_value_filled, {f32('value - pv')} AS value_change, "
        "CASE WHEN value - pv > 0 THEN 1 ELSE 0 END AS use_flag FROM g"
    )



# ------------------------------------------------------------- encoders, selection, metrics

def q_one_hot() -> str:
    cols = []
    for c, vals in [("o_orderstatus", ["F", "O", "P"]), ("o_orderpriority", PRIORITIES)]:
        for v in vals:
            cols.append(f"CAST({c} IS NOT DISTINCT FROM '{v}' AS INTEGER) AS {c}_{san(v)}")
        cols.append(f"CAST({c} IS NULL AS INTEGER) AS {c}_nan")
    return f"SELECT o_orderkey, {', '.join(cols)} FROM orders"


def q_target() -> str:
    return with_("docs") + (
        ", tl AS (SELECT lang, avg(CAST(quality AS DOUBLE)) AS v FROM docs WHERE lang IS NOT NULL GROUP BY lang), "
        "ts AS (SELECT source, avg(CAST(quality AS DOUBLE)) AS v FROM docs WHERE source IS NOT NULL GROUP BY source) "
        f"SELECT d.doc_id, {f32('tl.v')} AS lang_target_encode, {f32('ts.v')} AS source_target_encode "
        "FROM docs d LEFT JOIN tl ON d.lang = tl.lang LEFT JOIN ts ON d.source = ts.source"
    )


def q_child_target() -> str:
    sel = ["o_custkey"]
    for c, a in [("o_orderpriority", "p"), ("o_orderstatus", "s")]:
        for fn in ["min", "max", "mean", "median"]:
            sel.append(f"{f32(agg_sql(fn, a))} AS buro_{c}_target_encode_{fn}")
    return with_("c") + (
        ", ch AS (SELECT o.o_custkey, o.o_orderpriority, o.o_orderstatus, c.target FROM orders o LEFT JOIN c ON o.o_custkey = c.c_custkey), "
        "tp AS (SELECT o_orderpriority, avg(CAST(target AS DOUBLE)) AS v FROM ch WHERE o_orderpriority IS NOT NULL GROUP BY 1), "
        "tq AS (SELECT o_orderstatus, avg(CAST(target AS DOUBLE)) AS v FROM ch WHERE o_orderstatus IS NOT NULL GROUP BY 1), "
        "enc AS (SELECT ch.o_custkey, tp.v AS p, tq.v AS s FROM ch LEFT JOIN tp ON ch.o_orderpriority = tp.o_orderpriority "
        "LEFT JOIN tq ON ch.o_orderstatus = tq.o_orderstatus) "
        f"SELECT {', '.join(sel)} FROM enc GROUP BY o_custkey"
    )


def q_woe() -> str:
    def table(c):
        return (
            f"w_{c}0 AS (SELECT {c}, count_if(quality = 1) AS pos, count_if(quality = 0) AS neg FROM docs "
            f"WHERE {c} IS NOT NULL AND quality IN (0, 1) GROUP BY {c}), "
            f"w_{c} AS (SELECT {c}, CASE WHEN pos > 0 AND neg > 0 THEN ln((pos / (SELECT sum(pos) FROM w_{c}0)) / "
            f"(neg / (SELECT sum(neg) FROM w_{c}0))) END AS w FROM w_{c}0)"
        )

    return with_("docs") + (
        f", {table('lang')}, {table('source')} "
        f"SELECT d.doc_id, {f32('coalesce(a.w, 0)')} AS lang_woe, {f32('coalesce(b.w, 0)')} AS source_woe FROM docs d "
        "LEFT JOIN w_lang a ON d.lang = a.lang LEFT JOIN w_source b ON d.source = b.source"
    )


def q_factorize() -> str:
    return (
        "SELECT c_custkey, CAST(CASE WHEN c_mktsegment IS NULL THEN -1 ELSE DENSE_RANK() OVER (ORDER BY c_mktsegment) - 1 END AS INTEGER) "
        "AS c_mktsegment FROM customer"
    )


def q_value_map() -> str:
    n = "(CAST(quality IS NULL AS INTEGER) + CAST(toxic IS NULL AS INTEGER) + CAST(n_chars IS NULL AS INTEGER))"
    m = f"CASE {n} WHEN 0 THEN 0.7298178 WHEN 1 THEN 0.8178222 WHEN 2 THEN 0.9921877 END"
    return with_("docs") + f"SELECT doc_id, CAST({n} AS INTEGER) AS null_count, {f32(m)} AS null_score FROM docs"


WIDE = [
    ("l_orderkey", "CAST(l_orderkey AS DOUBLE)"), ("l_quantity", "l_quantity"), ("l_extendedprice", "l_extendedprice"),
    ("paid", "l_extendedprice * (1 - l_discount) * (1 + l_tax)"), ("l_discount", "l_discount"), ("l_tax", "l_tax"),
    ("unit_price", "l_extendedprice / l_quantity"), ("discount_amount", "l_extendedprice * l_discount"),
    ("quantity_scaled", "l_quantity * 2.0 + l_discount"),
]


def q_corr() -> str:
    cols = [n for n, _ in WIDE]
    w = "w AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in WIDE) + " FROM lineitem)"
    pairs = []
    for j in range(len(cols)):
        for i in range(j):
            a = f"CASE WHEN {cols[j]} IS NOT NULL THEN {cols[i]} END"
            b = f"CASE WHEN {cols[i]} IS NOT NULL THEN {cols[j]} END"
            den = f"(stddev_pop({a}) * stddev_pop({b}))"
            pairs.append(f"abs(CASE WHEN {den} > 0 THEN covar_pop({a}, {b}) / {den} END) AS r_{i}_{j}")
    parts = []
    for j, c in enumerate(cols):
        if j == 0:
            m = "CAST(NULL AS DOUBLE)"
        elif j == 1:
            m = "r_0_1"
        else:
            m = "greatest(" + ", ".join(f"r_{i}_{j}" for i in range(j)) + ")"
        drop = "0" if c == "l_orderkey" or j == 0 else f"CASE WHEN {m} > 0.9 THEN 1 ELSE 0 END"
        parts.append(f"SELECT '{c}' AS feature, {j} AS position, {f32(m)} AS max_abs_corr, CAST({drop} AS INTEGER) AS dropped FROM p")
    return f"WITH {w}, p AS (SELECT {', '.join(pairs)} FROM w) " + " UNION ALL ".join(
        f"SELECT feature, CAST(position AS INTEGER) AS position, max_abs_corr, dropped FROM ({x})" for x in parts
    )


def q_ranked() -> str:
    global RAW
    RAW = True
    try:
        block = q_flagship()
    finally:
        RAW = False
    return (
        f"WITH fs AS ({block}), u AS (UNPIVOT fs ON COLUMNS(* EXCLUDE (c_custkey)) INTO NAME feature VALUE v), "
        "m AS (SELECT feature, avg(CAST(v AS DOUBLE)) AS mv FROM u GROUP BY feature), "
        "r AS (SELECT feature, ROW_NUMBER() OVER (ORDER BY mv DESC, feature) AS rk, count(*) OVER () AS n FROM m) "
        "SELECT feature, CAST(rk AS INTEGER) AS rank, CAST(rk <= n - floor(n * 0.4) AS INTEGER) AS kept FROM r"
    )


def q_importance() -> str:
    return (
        f"SELECT 'c_acctbal' AS feature, {f32('sum(c_acctbal) / 5.0')} AS importance FROM customer UNION ALL "
        f"SELECT 'c_nationkey' AS feature, {f32('sum(CAST(c_nationkey AS DOUBLE)) / 5.0')} AS importance FROM customer"
    )


def _auc_body(group: str | None) -> str:
    part = f"PARTITION BY {group} " if group else ""
    part2 = f"PARTITION BY {group}, n_chars" if group else "PARTITION BY n_chars"
    g = f"{group}, " if group else ""
    return with_("docs") + (
        f", l AS (SELECT {g}quality, n_chars FROM docs WHERE quality IS NOT NULL AND n_chars IS NOT NULL), "
        f"rn AS (SELECT *, ROW_NUMBER() OVER ({part}ORDER BY n_chars) AS r FROM l), "
        f"rk AS (SELECT *, avg(r) OVER ({part2}) AS ar FROM rn), "
        f"a AS (SELECT {g}(sum(ar) FILTER (WHERE quality = 1) - count_if(quality = 1) * (count_if(quality = 1) + 1) / 2.0) "
        f"/ nullif(count_if(quality = 1) * count_if(quality = 0), 0) AS auc FROM rk{' GROUP BY ' + group if group else ''}) "
    )


def q_auc() -> str:
    return _auc_body(None) + f"SELECT {f32('auc')} AS auc FROM a"


def q_auc_group() -> str:
    return _auc_body("lang") + f"SELECT lang, {f32('auc')} AS auc FROM a"


def q_gini() -> str:
    return _auc_body(None) + f"SELECT {f32('2 * auc - 1')} AS gini FROM a"


def q_blend() -> str:
    return with_("docs") + (
        ", tl AS (SELECT lang, avg(CAST(quality AS DOUBLE)) AS v FROM docs WHERE lang IS NOT NULL GROUP BY lang), "
        "ts AS (SELECT source, avg(CAST(quality AS DOUBLE)) AS v FROM docs WHERE source IS NOT NULL GROUP BY source), "
        "p AS (SELECT d.doc_id, tl.v AS score FROM docs d LEFT JOIN tl ON d.lang = tl.lang UNION ALL "
        "SELECT d.doc_id, ts.v AS score FROM docs d LEFT JOIN ts ON d.source = ts.source) "
        f"SELECT doc_id, {f32('avg(score)')} AS score FROM p GROUP BY doc_id"
    )


def q_top40() -> str:
    return (
        f"SELECT l_partkey, {f32('m')} AS mean_price FROM (SELECT l_partkey, avg(l_extendedprice) AS m FROM lineitem "
        "GROUP BY l_partkey ORDER BY m DESC, l_partkey LIMIT 40)"
    )


def q_union() -> str:
    return with_("docs") + (
        "SELECT doc_id, lang, quality FROM docs WHERE quality IS NOT NULL "
        "UNION ALL BY NAME SELECT doc_id, lang, n_chars FROM docs WHERE quality IS NULL"
    )



# ------------------------------------------------------------- exact cuts, folds and samples


def hash_order(seed: int, key: str, partition: str = "") -> str:
    """Row number in the order of the seeded key hash."""
    part = f"PARTITION BY {partition} " if partition else ""
    return f"row_number() OVER ({part}ORDER BY md5('{seed}|' || CAST({key} AS VARCHAR)), {key})"


def _cut() -> str:
    return (
        with_("docs") + f", lab AS (SELECT *, {hash_order(1222, 'doc_id')} AS r, count(*) OVER () AS n FROM docs WHERE quality IS NOT NULL), "
        "cut AS (SELECT *, CAST(r <= round_even(n * 0.9, 0) AS INTEGER) AS is_train FROM lab) "
    )


def q_split() -> str:
    return _cut() + (
        "SELECT doc_id, lang, quality, is_train, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS BIGINT) AS n_chars FROM cut "
        "UNION ALL SELECT doc_id, lang, NULL, -1, source, n_chars FROM docs WHERE quality IS NULL"
    )


def q_load_split() -> str:
    return _cut() + (
        "SELECT doc_id, lang, source, n_chars, toxic, is_train FROM cut "
        "UNION ALL SELECT doc_id, lang, source, n_chars, toxic, -1 FROM docs WHERE quality IS NULL"
    )


def q_kfold() -> str:
    return with_("docs") + f"SELECT doc_id, CAST(({hash_order(5407, 'doc_id')} - 1) % 5 AS INTEGER) AS fold FROM docs WHERE quality IS NOT NULL"


def q_stratified() -> str:
    return with_("docs") + (
        f"SELECT doc_id, quality, CAST(({hash_order(5407, 'doc_id', 'quality')} - 1) % 5 AS INTEGER) AS fold FROM docs WHERE quality IS NOT NULL"
    )


def q_sample() -> str:
    return f"SELECT o_orderkey, o_custkey FROM (SELECT *, {hash_order(42, 'o_orderkey')} AS r FROM orders) WHERE r <= 500"


# ------------------------------------------------------------- row expressions, typing, sources, UDF

APP = (
    CTE["o"] + ", s AS (SELECT o_custkey, sum(o_totalprice) AS amt_credit, avg(o_totalprice) AS amt_annuity, "
    "max(o_totalprice) AS amt_goods_price, min(o_days) AS days_birth, max(o_days) AS days_employed, "
    "CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS cnt_children, count(*) AS cnt_fam_members, "
    "CAST(max(o_orderkey) % 30 AS DOUBLE) AS own_car_age, nullif(min(o_orderkey) % 5 * -100, 0) AS days_last_phone_change, "
    "avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS ext_source_1, "
    "avg(CASE WHEN o_orderpriority = '2-HIGH' THEN 1.0 ELSE 0.0 END) AS ext_source_2, "
    "avg(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1.0 ELSE 0.0 END) AS ext_source_3 FROM o GROUP BY o_custkey), "
    "a AS (SELECT c.c_custkey, CAST(c.c_acctbal < 0 AS INTEGER) AS target, c.c_mktsegment, c.c_nationkey, "
    "c.c_acctbal AS amt_income_total, s.* EXCLUDE (o_custkey) FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey)"
)
EXT = ["ext_source_1", "ext_source_2", "ext_source_3"]


def rat(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def row_stats(cols_: list[str]) -> dict:
    lst = "[" + ", ".join(cols_) + "]"
    nn = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols_)
    sm = " + ".join(f"coalesce({c}, 0)" for c in cols_)
    return {
        "min": f"least({', '.join(cols_)})",
        "max": f"greatest({', '.join(cols_)})",
        "sum": sm,
        "mean": f"({sm}) / nullif({nn}, 0)",
        "median": f"list_aggregate({lst}, 'median')",
        "std": f"list_aggregate({lst}, 'stddev_samp')",
    }


def q_application() -> str:
    r = row_stats(EXT)
    sel = [
        f"{f32(rat('amt_annuity', 'amt_income_total'))} AS annuity_income_percentage",
        f"{f32(rat('own_car_age', 'days_birth'))} AS car_to_birth_ratio",
        f"{f32(rat('own_car_age', 'days_employed'))} AS car_to_employ_ratio",
        f"{f32(rat('days_last_phone_change', 'days_birth'))} AS phone_to_birth_ratio",
        f"{f32(rat('days_last_phone_change', 'days_employed'))} AS phone_to_employ_ratio",
        f"{f32(rat('cnt_children', 'cnt_fam_members'))} AS children_ratio",
        f"{f32(rat('amt_credit', 'amt_annuity'))} AS credit_to_annuity_ratio",
        f"{f32(rat('amt_credit', 'amt_goods_price'))} AS credit_to_goods_ratio",
        f"{f32(rat('amt_credit', 'amt_income_total'))} AS credit_to_income_ratio",
        f"{f32(rat('days_employed', 'days_birth'))} AS days_employed_percentage",
        f"{f32(rat('amt_income_total', 'amt_credit'))} AS income_credit_percentage",
        f"{f32(rat('amt_income_total', '1 + cnt_children'))} AS income_per_child",
        f"{f32(rat('amt_income_total', 'cnt_fam_members'))} AS income_per_person",
        f"{f32(rat('amt_annuity', 'amt_credit'))} AS payment_rate",
        f"{f32('ext_source_1 * 2.0 + ext_source_2 * 3.0 + ext_source_3 * 4.0')} AS external_sources_weighted",
        f"{f32(r['min'])} AS external_sources_min",
        f"{f32(r['max'])} AS external_sources_max",
        f"{f32(r['sum'])} AS external_sources_sum",
        f"{f32(r['mean'])} AS external_sources_mean",
        f"{f32(r['median'])} AS external_sources_nanmedian",
        f"{f32(r['std'])} AS external_sources_std",
        "CASE WHEN days_employed > -2000 THEN 1 ELSE 0 END AS short_employment",
        "CASE WHEN days_birth > -14000 THEN 1 ELSE 0 END AS young_age",
    ]
    return f"WITH {APP} SELECT c_custkey, {', '.join(sel)} FROM a"


def q_scrub() -> str:
    ps = "CASE WHEN o_totalprice > 450000 THEN NULL ELSE o_totalprice END"
    return with_("o") + (
        "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status_scrubbed, "
        f"{f32(ps)} AS price_scrubbed, {f32(f'coalesce({ps}, CAST(o_days AS DOUBLE))')} AS price_or_days, "
        f"{f32(f'coalesce({ps}, 1.0)')} AS price_or_one, "
        "CAST(CASE WHEN o_days + 2000 > 0 THEN o_days + 2000 ELSE 0 END AS INTEGER) AS days_clamped, "
        f"{f32('1.0 - o_totalprice / nullif(o_totalprice + 1000, 0)')} AS price_complement, "
        "CASE WHEN o_totalprice / 1000 > -o_days THEN 1 ELSE 0 END AS price_gt_age, "
        "CAST((o_orderstatus = 'O')::INTEGER + (o_orderpriority = '1-URGENT')::INTEGER + (o_days > -365)::INTEGER AS INTEGER) AS flag_sum, "
        f"{f32('o_totalprice - o_days * 100')} AS price_minus_days FROM o"
    )


def q_narrow() -> str:
    def ints(c):
        return (
            f"SELECT '{c}' AS \"column\", CASE WHEN min({c}) > -128 AND max({c}) < 127 THEN 'tinyint' "
            f"WHEN min({c}) > -32768 AND max({c}) < 32767 THEN 'smallint' "
            f"WHEN min({c}) > -2147483648 AND max({c}) < 2147483647 THEN 'int' ELSE 'bigint' END AS narrowed FROM customer"
        )

    dbl = (
        "SELECT 'c_acctbal' AS \"column\", CASE WHEN min(c_acctbal) > -3.4028234663852886e38 AND max(c_acctbal) < 3.4028234663852886e38 "
        "THEN 'float' ELSE 'double' END AS narrowed FROM customer"
    )
    return " UNION ALL ".join([ints("c_custkey"), ints("c_nationkey"), dbl])


def q_type_split() -> str:
    parts = [f"SELECT '{c}' AS \"column\", 'categorical' AS kind" for c in ["o_orderstatus", "o_orderpriority"]]
    for c in ["o_orderkey", "o_custkey", "o_totalprice", "o_days"]:
        parts.append(f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) < 25 THEN 'discrete' ELSE 'continuous' END AS kind FROM o")
    return with_("o") + " UNION ALL ".join(parts)


def q_binary() -> str:
    exprs = []
    for c, vals in [("o_orderstatus", ["F", "O", "P"]), ("o_orderpriority", PRIORITIES)]:
        for v in vals:
            exprs.append((f"{c}_{san(v)}", f"CAST({c} IS NOT DISTINCT FROM '{v}' AS INTEGER)"))
        exprs.append((f"{c}_nan", f"CAST({c} IS NULL AS INTEGER)"))
    exprs.append(("o_totalprice", "o_totalprice"))
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", CAST(min({e}) = 0 AND max({e}) = 1 AS INTEGER) AS is_binary FROM orders" for n, e in exprs
    )


def q_csv() -> str:
    return f"SELECT c_custkey, c_name, c_nationkey, {f32('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer"


def q_capped() -> str:
    return f"SELECT o_orderkey, o_custkey, {f32('o_totalprice')} AS o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100"


def q_projected() -> str:
    return f"SELECT l_orderkey, {f32('l_extendedprice')} AS l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'"


def q_ranked_list() -> str:
    return (
        "SELECT feature, CAST(ROW_NUMBER() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM ("
        "SELECT 'c_acctbal' AS feature, sum(c_acctbal) AS importance FROM customer UNION ALL "
        "SELECT 'c_nationkey' AS feature, sum(CAST(c_nationkey AS DOUBLE)) AS importance FROM customer)"
    )


def q_grouped() -> str:
    return (
        "SELECT user_id, count(*) AS n, "
        f"{f32('max(gap)')} AS gap_max FROM (SELECT user_id, "
        "date_diff('microsecond', LAG(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) / 1e6 AS gap FROM events) GROUP BY user_id"
    )


# ------------------------------------------------------------- kernel blocks


def kname(prefix, c, tag, fn):
    return f"{prefix}{c}{'_' + tag if tag else ''}_{fn}"


def q_k_pos() -> str:
    spec = {"e_days": ["max", "mean", "size", "sum"], "sk_dpd": ["max", "sum", "mean", "nonzero"], "sk_dpd_def": ["max", "sum", "mean", "nonzero"]}
    types = {"e_days": "int", "sk_dpd": "int", "sk_dpd_def": "int"}
    slices = [("", None), ("2y", "e_days >= -24"), ("1y", "e_days >= -12"), ("05y", "e_days >= -6")]
    sel = ["user_id"]
    for tag, w in slices:
        for c, fns in spec.items():
            for fn in fns:
                sel.append(f"{fagg(fn, c, w, None, types[c])} AS {kname('pos_', c, tag, fn)}")
        for v in ["click", "error", "purchase", "signup", "view"]:
            name = kname("pos_", "event_type", tag, f"share_{v}")
            if name == "pos_event_type_05y_share_signup":
                continue
            sel.append(f"{f32(f'avg(CASE WHEN event_type IS NOT DISTINCT FROM {chr(39)}{v}{chr(39)} THEN 1 ELSE 0 END){filt(w)}')} AS {name}")
        for v in ["click", "error", "purchase", "signup", "view"]:
            sel.append(f"{fagg('size', '1', w)} AS {kname('pos_', 'event_type', tag, f'size_{v}')}")
    return f"WITH {POS_ROWS} SELECT {', '.join(sel)} FROM p GROUP BY user_id"


def q_k_ins() -> str:
    spec = {
        "i_version": ["nunique", "sum"], "dpd": ["max", "mean", "sum", "std", "nonzero"], "dbd": ["max", "mean", "sum", "std", "nonzero"],
        "payment_perc": ["max", "mean", "sum", "std"], "payment_diff": ["max", "mean", "sum", "std"], "i_due": ["max", "mean", "sum", "std"],
        "i_paid": ["min", "mean", "sum"], "i_days_paid": ["max", "mean", "sum"],
    }
    types = {"i_version": "int", "dpd": "int", "dbd": "int", "payment_perc": "double", "payment_diff": "double",
             "i_due": "double", "i_paid": "double", "i_days_paid": "int"}
    slices = [("", None), ("2y", "i_days_due >= -730"), ("1y", "i_days_due >= -365"), ("05y", "i_days_due >= -182"), ("025y", "i_days_due >= -91")]
    sel = ["o_custkey AS c_custkey"]
    for tag, w in slices:
        for c, fns in spec.items():
            for fn in fns:
                sel.append(f"{fagg(fn, c, w, None, types[c])} AS {kname('ins_', c, tag, fn)}")
    sel.append("count(*) AS ins_count")
    rows = (
        CTE["ins"] + ", k AS (SELECT *, 1.0 - i_paid / nullif(i_due, 0) AS payment_perc, i_due - i_paid AS payment_diff, "
        "CASE WHEN i_days_paid - i_days_due > 0 THEN i_days_paid - i_days_due ELSE 0 END AS dpd, "
        "CASE WHEN i_days_due - i_days_paid > 0 THEN i_days_due - i_days_paid ELSE 0 END AS dbd FROM ins)"
    )
    return f"WITH {rows} SELECT {', '.join(sel)} FROM k GROUP BY o_custkey"


def q_k_cards() -> str:
    rows = (
        POS_ROWS + f", cc AS ({CARD_TABLE}), "
        "c2 AS (SELECT *, CAST(amt_balance AS DOUBLE) / nullif(amt_credit_limit_actual, 0) AS balance_credit_ratio, "
        "amt_payment_total_current / nullif(amt_drawings_current, 0) AS required_payment_gap FROM cc)"
    )
    spec = {
        "sk_dpd": ["max", "sum", "mean", "nonzero"], "sk_dpd_def": ["max", "sum", "mean", "nonzero"],
        **{a: ["min", "max", "mean", "var"] for a in ["amt_balance", "amt_credit_limit_actual", "amt_drawings_current", "amt_payment_total_current", "cnt_drawings_current"]},
        "balance_credit_ratio": ["mean", "std"], "required_payment_gap": ["mean", "min", "std"],
    }
    types = {k: "double" for k in spec}
    types.update({"sk_dpd": "int", "sk_dpd_def": "int", "cnt_drawings_current": "int"})
    slices = [("", None), ("2y", "months_balance >= -24"), ("1y", "months_balance >= -12"), ("05y", "months_balance >= -6")]
    sel = ["sk_id_curr"]
    for tag, w in slices:
        for c, fns in spec.items():
            for fn in fns:
                sel.append(f"{fagg(fn, c, w, None, types[c])} AS {kname('cc_', c, tag, fn)}")
    sel.append("count(*) AS cc_count")
    return f"WITH {rows} SELECT {', '.join(sel)} FROM c2 GROUP BY sk_id_curr"



def q_rank_quantiles() -> str:
    parts, cols = [], []
    for i, (tag, w) in enumerate([("", None), ("opn", "o_orderstatus = 'O'")]):
        t = f"_{tag}" if tag else ""
        body = (
            f"{f32('median(o_totalprice)')} AS q_o_totalprice{t}_median, "
            f"{f32(agg_sql('iqr', 'o_totalprice'))} AS q_o_totalprice{t}_iqr, "
            f"{f32('median(o_days)')} AS q_o_days{t}_median"
        )
        where = f" WHERE {w}" if w else ""
        parts.append(f"LEFT JOIN (SELECT o_custkey AS k, {body} FROM o{where} GROUP BY o_custkey) s{i} ON sp.o_custkey = s{i}.k")
        cols += [f"s{i}.q_o_totalprice{t}_median", f"s{i}.q_o_totalprice{t}_iqr", f"s{i}.q_o_days{t}_median"]
    return with_("o") + f"SELECT sp.o_custkey, {', '.join(cols)} FROM (SELECT DISTINCT o_custkey FROM o) sp " + " ".join(parts)


def q_global_fills() -> str:
    p = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END"
    return (
        f"SELECT o_orderkey, {f32(f'coalesce({p}, (SELECT median(o_totalprice) FROM orders WHERE o_orderstatus <> {chr(39)}P{chr(39)}))')} AS price_med, "
        f"{f32(f'coalesce({p}, (SELECT avg(o_totalprice) FROM orders WHERE o_orderstatus <> {chr(39)}P{chr(39)}))')} AS price_mean FROM orders"
    )



# rows of the roles that several blocks share (the mapping of loomfeat.plans.blocks)

N = "o_orderkey"
DAYS = f"CAST(CAST(o_orderdate AS DATE) - {ORDERS_REF} AS INTEGER)"


def _due(e: str) -> str:
    return f"CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {e} END"


def _code(letter: str, m: int, shift: int = 0) -> str:
    return f"'{letter}' || CAST(({N} + {shift}) % {m} AS VARCHAR)"


PREV_CATEGORIES = {
    "name_contract_type": "o_orderpriority",
    "weekday_appr_process_start": "CAST(dayofweek(o_orderdate) + 1 AS VARCHAR)",
    "hour_appr_process_start": f"CAST({N} % 24 AS VARCHAR)",
    "name_cash_loan_purpose": f"CASE WHEN {N} % 3 <> 0 THEN {_code('purpose ', 5)} END",
    "name_contract_status": "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END",
    "name_payment_type": _code("pay ", 4, 1),
    "code_reject_reason": f"CASE WHEN o_orderstatus = 'O' THEN {_code('reason ', 3)} END",
    "name_type_suite": f"CASE WHEN {N} % 7 <> 0 THEN {_code('suite ', 6, 2)} END",
    "name_client_type": f"CASE WHEN {N} % 2 = 0 THEN 'Repeater' ELSE 'New' END",
    "name_goods_category": _code("goods ", 9, 3),
    "name_portfolio": _code("portfolio ", 4, 5),
    "name_product_type": f"CASE WHEN {N} % 5 = 0 THEN 'x-sell' ELSE 'walk-in' END",
    "channel_type": _code("channel ", 8, 7),
    "name_seller_industry": _code("industry ", 10, 1),
    "name_yield_group": "CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low' END",
    "product_combination": "o_orderstatus || ' ' || o_orderpriority[1:1]",
}
PREV_VALUES = {
    "name_contract_type": PRIORITIES,
    "weekday_appr_process_start": [str(i) for i in range(1, 8)],
    "hour_appr_process_start": [str(i) for i in range(24)],
    "name_cash_loan_purpose": [f"purpose {i}" for i in range(5)],
    "name_contract_status": ["Approved", "Canceled", "Refused"],
    "name_payment_type": [f"pay {i}" for i in range(4)],
    "code_reject_reason": [f"reason {i}" for i in range(3)],
    "name_type_suite": [f"suite {i}" for i in range(6)],
    "name_client_type": ["New", "Repeater"],
    "name_goods_category": [f"goods {i}" for i in range(9)],
    "name_portfolio": [f"portfolio {i}" for i in range(4)],
    "name_product_type": ["walk-in", "x-sell"],
    "channel_type": [f"channel {i}" for i in range(8)],
    "name_seller_industry": [f"industry {i}" for i in range(10)],
    "name_yield_group": ["high", "low", "middle"],
    "product_combination": [f"{a} {b}" for a in "FOP" for b in "12345"],
}
PREV_TABLE = (
    f"pr AS (SELECT o_custkey AS sk_id_curr, {N} AS sk_id_prev, "
    + ", ".join(f"{e} AS {c}" for c, e in PREV_CATEGORIES.items())
    + f", o_totalprice AS amt_credit, o_totalprice * (CAST(0.83 AS DOUBLE) + ({N} % 7) / CAST(17.0 AS DOUBLE)) AS amt_application, "
    f"o_totalprice / (6 + {N} % 25) AS amt_annuity, {_due(f'o_totalprice * ({N} % 10) / CAST(100.0 AS DOUBLE)')} AS amt_down_payment, "
    f"nullif(o_totalprice - fmod(o_totalprice, 1000), 0) AS amt_goods_price, {_due(f'({N} % 10) / CAST(100.0 AS DOUBLE)')} AS rate_down_payment, "
    f"CASE WHEN {N} % 11 <> 0 THEN CAST(12 + {N} % 48 AS DOUBLE) END AS cnt_payment, "
    f"{DAYS} AS days_decision, {DAYS} + 30 AS days_first_due, {_due(f'{DAYS} + 300 + {N} % 90')} AS days_last_due_1st_version, "
    f"{_due(f'{DAYS} + 365')} AS days_last_due, {_due(f'{DAYS} + 370 + {N} % 60')} AS days_termination, {_due(f'{DAYS} + {N} % 20')} AS days_first_drawing "
    "FROM orders)"
)
CARD_TABLE = (
    "SELECT user_id AS sk_id_curr, event_type AS sk_id_prev, ts, event_id, e_days AS months_balance, "
    "CASE WHEN event_id % 4 = 0 THEN 'Completed' ELSE 'Active' END AS name_contract_status, "
    "CASE WHEN event_id % 9 = 0 THEN 0.0 ELSE value END AS amt_balance, value * 2 + event_id % 13 AS amt_credit_limit_actual, "
    "CASE WHEN value < 5 THEN NULL ELSE value - 5 END AS amt_drawings_current, "
    "value * ((event_id % 5) / CAST(8.0 AS DOUBLE)) AS amt_payment_current, "
    "CASE WHEN event_type = 'purchase' THEN value WHEN event_id % 17 = 0 THEN NULL ELSE 0.0 END AS amt_payment_total_current, "
    "value * CAST(0.75 AS DOUBLE) + event_id % 6 AS amt_receivable_principal, value + event_id % 10 AS amt_recivable, "
    "sk_dpd AS cnt_drawings_current, sk_dpd, sk_dpd_def FROM p"
)


REQUESTS = {"hour": 2, "day": 3, "week": 4, "mon": 5, "qrt": 6, "year": 7}
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def q_k_app() -> str:
    r = row_stats(EXT)
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in EXT)
    flag = lambda e: f"CASE WHEN {e} THEN 1 ELSE 0 END"
    sel = [
        "b.c_custkey", "b.target", f"{f32('b.amt_income_total')} AS amt_income_total", f"{f32('b.amt_credit')} AS amt_credit",
        f"{f32('b.amt_annuity')} AS amt_annuity", f"{f32('b.amt_goods_price')} AS amt_goods_price",
        "b.days_birth", "b.days_employed", "b.cnt_children", "b.cnt_fam_members",
        *[f"{f32('b.' + e)} AS {e}" for e in EXT],
        f"{f32('b.own_car_age')} AS own_car_age", "b.days_last_phone_change", "b.c_nationkey",
        *[f"b.c_custkey % {m} AS amt_req_credit_bureau_{n}" for n, m in REQUESTS.items()],
        f"CAST({flag('b.cnt_children > 0')} + {flag('b.amt_income_total > 0')} + {flag('b.days_employed > -365')} AS INTEGER) AS document_sel",
        "CAST(CASE WHEN b.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 0 ELSE 1 END AS INTEGER) AS c_segment_bin",
        f"{f32('te.v')} AS c_mktsegment_target_encode",
        *[f"CAST(b.c_mktsegment IS NOT DISTINCT FROM '{v}' AS INTEGER) AS c_mktsegment_{v.lower()}" for v in SEGMENTS],
        f"{f32(rat('b.amt_income_total', 'b.cnt_fam_members'))} AS income_per_person",
        f"{f32(rat('b.days_employed', 'b.days_birth'))} AS days_employed_perc",
        f"{f32(rat('b.amt_income_total', 'b.amt_credit'))} AS income_credit_perc",
        f"{f32(rat('b.amt_credit', 'b.amt_annuity'))} AS annuity_length",
        f"{f32(rat('b.amt_annuity', 'b.amt_credit'))} AS payment_rate",
        f"{f32(rat('b.amt_credit', 'b.amt_goods_price'))} AS consumer_goods_ratio",
        f"{f32(f'CASE {nulls} WHEN 0 THEN 0.7298178 WHEN 1 THEN 0.8178222 WHEN 2 THEN 0.9921877 END')} AS empty_ext",
        f"{f32(rat('b.amt_credit', 'b.amt_income_total'))} AS credit_to_income",
        f"{f32(rat('b.amt_income_total', 'b.amt_annuity'))} AS income_to_annuity",
        f"{f32(rat(rat('b.amt_income_total', 'b.cnt_fam_members'), 'b.amt_annuity'))} AS income_person_to_annuity",
        f"{f32(rat('b.amt_income_total', 'b.amt_goods_price'))} AS income_to_price",
        f"{f32(r['max'] + ' - ' + r['min'])} AS score_spread",
        f"{f32(rat('b.amt_income_total', '(1 + b.cnt_children)'))} AS new_inc_per_chld",
        f"{f32(rat('b.amt_annuity', '(1 + b.amt_income_total)'))} AS new_annuity_to_income_ratio",
        f"{f32('b.ext_source_1 * b.ext_source_2 * b.ext_source_3')} AS new_sources_prod",
        f"{f32(r['mean'])} AS new_ext_sources_mean",
        f"{f32('coalesce(' + r['std'] + ', avg(' + r['std'] + ') OVER ())')} AS new_scores_std",
        f"{f32(rat('b.days_last_phone_change', 'b.days_employed'))} AS new_phone_to_birth_ratio",
        f"{f32(rat('b.amt_credit', 'b.amt_income_total'))} AS new_credit_to_income_ratio",
        *[f"{f32(rat(f'(b.c_custkey % {REQUESTS[x]})', f'(b.c_custkey % {REQUESTS[y]})'))} AS {x}_by_{y}" for x, y in zip(list(REQUESTS), list(REQUESTS)[1:])],
        f"{flag('b.amt_credit > b.amt_goods_price')} AS over_expect_credit",
    ]
    body = ", ".join(sel).replace("ext_source_1,", "ext_source_1,")
    return (
        f"WITH {APP}, b AS (SELECT * FROM a), "
        "te AS (SELECT c_mktsegment, avg(CAST(target AS DOUBLE)) AS v FROM a WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment) "
        f"SELECT {body} FROM b LEFT JOIN te ON b.c_mktsegment = te.c_mktsegment"
    ).replace("least(ext_source_1, ext_source_2, ext_source_3)", "least(b.ext_source_1, b.ext_source_2, b.ext_source_3)")


def q_k_prev() -> str:
    cats = [c for c in PREV_CATEGORIES if c != "hour_appr_process_start"]
    num = {
        "amt_annuity": ["min", "max", "mean"], "amt_application": ["min", "max", "mean"], "amt_credit": ["min", "max", "mean"],
        "app_credit_perc": ["mean"], "amt_down_payment": ["min", "max", "mean"], "amt_goods_price": ["min", "max", "mean"],
        "hour_appr_process_start": ["min", "max", "mean"], "rate_down_payment": ["min", "max", "mean"],
        "days_decision": ["min", "max", "mean", "std"], "cnt_payment": ["mean", "sum", "max", "std"],
        "spread": ["mean"], "annuity_length": ["mean"], "consumer_goods_ratio": ["mean"],
        **{f"{c}_target_encode": ["min", "max", "mean", "median"] for c in cats},
    }
    types = {k: "double" for k in num} | {"hour_appr_process_start": "int", "days_decision": "int"}
    sel = ["sk_id_curr AS c_custkey"]
    for c, fns in num.items():
        sel += [f"{fagg(fn, c, None, None, types[c])} AS {kname('prev_', c, '', fn)}" for fn in fns]
    for c in cats:
        for v in [*PREV_VALUES[c], None]:
            hit = f"{c} IS NULL" if v is None else f"{c} IS NOT DISTINCT FROM '{v}'"
            sel.append(f"{f32(f'avg(CASE WHEN {hit} THEN 1 ELSE 0 END)')} AS prev_{c}_share_{'nan' if v is None else san(v)}")
    windows = [("", None), ("05y", "days_decision >= -282"), ("1y", "days_decision >= -365"), ("2y", "days_decision >= -730"), ("3y", "days_decision >= -1095")]
    for pre, st in [("apr_", "Approved"), ("ref_", "Refused")]:
        for tag, w in windows:
            cond = f"name_contract_status = '{st}'" + (f" AND {w}" if w else "")
            for c, fns in num.items():
                sel += [f"{fagg(fn, c, cond, None, types[c])} AS {kname(pre, c, tag, fn)}" for fn in fns]
    tables = ", ".join(f"t{i} AS (SELECT {c}, avg(CAST(target AS DOUBLE)) AS v FROM pl WHERE {c} IS NOT NULL GROUP BY 1)" for i, c in enumerate(cats))
    return (
        f"WITH {PREV_TABLE}, pl AS (SELECT pr.*, CAST(c_acctbal < 0 AS INTEGER) AS target FROM pr LEFT JOIN customer ON sk_id_curr = c_custkey), {tables}, "
        "p AS (SELECT pl.* REPLACE (CAST(pl.hour_appr_process_start AS INTEGER) AS hour_appr_process_start), "
        + ", ".join(f"t{i}.v AS {c}_target_encode" for i, c in enumerate(cats))
        + ", amt_application / nullif(amt_credit, 0) AS app_credit_perc, amt_application - amt_credit AS spread, amt_credit / nullif(amt_annuity, 0) AS annuity_length, "
        "amt_credit / nullif(amt_goods_price, 0) AS consumer_goods_ratio FROM pl "
        + " ".join(f"LEFT JOIN t{i} ON pl.{c} = t{i}.{c}" for i, c in enumerate(cats))
        + f") SELECT {', '.join(sel)} FROM p GROUP BY sk_id_curr"
    )


BUREAU_K = (
    "c AS (SELECT c_custkey, CAST(c_acctbal < 0 AS INTEGER) AS target FROM customer), "
    "br AS (SELECT o_custkey AS sk_id_curr, o_orderkey AS sk_id_bureau, "
    "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' END AS credit_active, o_orderpriority AS credit_type, "
    f"CAST(CAST(o_orderdate AS DATE) - {ORDERS_REF} AS INTEGER) AS days_credit, "
    f"CAST(CAST(o_orderdate AS DATE) - {ORDERS_REF} AS INTEGER) + 30 * (o_orderkey % 13) AS days_credit_enddate, "
    "o_totalprice AS amt_credit_sum, CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END AS amt_credit_sum_debt, "
    "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0.0 END AS amt_credit_sum_overdue, "
    "nullif(o_totalprice / 12, 0) AS amt_annuity FROM orders), "
    "bb AS (SELECT l_orderkey, min(l_linenumber) AS months_balance_min, max(l_linenumber) AS months_balance_max, "
    "count(*) AS months_balance_size, "
    + ", ".join(f"avg(CASE WHEN l_returnflag IS NOT DISTINCT FROM '{v}' THEN 1 ELSE 0 END) AS status_{v.lower()}_mean" for v in "ANR")
    + " FROM lineitem GROUP BY l_orderkey), "
    "b0 AS (SELECT br.*, bb.* EXCLUDE (l_orderkey), c.target, amt_credit_sum_debt / nullif(1 + amt_credit_sum, 0) AS amt_credit_debt_rate, "
    "amt_credit_sum / nullif(amt_annuity, 0) AS annuity_length FROM br LEFT JOIN bb ON br.sk_id_bureau = bb.l_orderkey "
    "LEFT JOIN c ON br.sk_id_curr = c.c_custkey), "
    "t1 AS (SELECT credit_type, avg(CAST(target AS DOUBLE)) AS v FROM b0 WHERE credit_type IS NOT NULL GROUP BY credit_type), "
    "t2 AS (SELECT credit_active, avg(CAST(target AS DOUBLE)) AS v FROM b0 WHERE credit_active IS NOT NULL GROUP BY credit_active), "
    "b AS (SELECT b0.*, t1.v AS credit_type_target_encode, t2.v AS credit_active_target_encode FROM b0 "
    "LEFT JOIN t1 ON b0.credit_type = t1.credit_type LEFT JOIN t2 ON b0.credit_active = t2.credit_active)"
)


def q_k_bureau() -> str:
    num = {
        "days_credit": ["min", "max", "mean", "std"], "days_credit_enddate": ["min", "max", "mean", "std"],
        "amt_credit_sum": ["max", "mean", "sum", "std"], "amt_credit_sum_debt": ["max", "mean", "sum"],
        "amt_credit_sum_overdue": ["mean"], "amt_annuity": ["max", "mean"], "months_balance_min": ["min"],
        "months_balance_max": ["max"], "months_balance_size": ["mean", "sum"], "annuity_length": ["min", "max", "mean"],
        "amt_credit_debt_rate": ["max", "mean"], "credit_type_target_encode": ["min", "max", "mean", "median"],
        "credit_active_target_encode": ["min", "max", "mean", "median"],
    }
    types = {k: "double" for k in num}
    types.update({"days_credit": "int", "days_credit_enddate": "bigint", "months_balance_min": "int", "months_balance_max": "int", "months_balance_size": "bigint"})
    sel = ["sk_id_curr AS c_custkey"]
    for c, fns in num.items():
        for fn in fns:
            sel.append(f"{fagg(fn, c, None, None, types[c])} AS {kname('buro_', c, '', fn)}")
    share = lambda col, v, w=None: f32(f"avg(CASE WHEN {col} IS NOT DISTINCT FROM '{v}' THEN 1 ELSE 0 END){filt(w)}")
    for v in ["Active", "Closed"]:
        sel.append(f"{share('credit_active', v)} AS buro_credit_active_share_{v.lower()}")
    for v in PRIORITIES:
        sel.append(f"{share('credit_type', v)} AS buro_credit_type_share_{san(v)}")
    for c in ["credit_active", "credit_type"]:
        sel.append(f"{f32(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)')} AS buro_{c}_share_nan")
    for v in "anr":
        sel.append(f"{f32(f'avg(status_{v}_mean)')} AS buro_status_{v}_mean_mean")
    windows = [("", None), ("025y", "days_credit >= -141"), ("05y", "days_credit >= -282"), ("1y", "days_credit >= -365"), ("2y", "days_credit >= -730")]
    for pre, st in [("act_", "Active"), ("cls_", "Closed")]:
        for tag, w in windows:
            cond = f"credit_active = '{st}'" + (f" AND {w}" if w else "")
            for c, fns in num.items():
                for fn in fns:
                    sel.append(f"{fagg(fn, c, cond, None, types[c])} AS {kname(pre, c, tag, fn)}")
    for v in PRIORITIES:
        cond = f"credit_type IS NOT DISTINCT FROM '{v}'"
        for c, fns in num.items():
            for fn in fns:
                sel.append(f"{fagg(fn, c, cond, None, types[c])} AS type_{san(v)}_{c}_{fn}")
    return f"WITH {BUREAU_K} SELECT {', '.join(sel)} FROM b GROUP BY sk_id_curr"



def q_balance_block() -> str:
    sel = ["sp.sk_id_curr AS c_custkey", "CAST(coalesce(m.bureau_miss_time, 0) AS BIGINT) AS bureau_miss_time"]
    for c in ["overdue_mean", "overdue_sum"]:
        for fn in ["mean", "max", "std", "sum", "median"]:
            sel.append(f"coalesce({typed(fn, agg_sql(fn, c), 'double')}, 0) AS bureau_{c}_{fn}")
    flags = ["a", "n", "r"]
    stat = [f"coalesce(st.balance_status_{v}, 0) AS balance_status_{v}" for v in flags]
    stat += ["coalesce(st.status_total, 0) AS status_total"]
    stat += [f"coalesce(st.balance_status_{v}_rate, 0) AS balance_status_{v}_rate" for v in flags]
    return (
        "WITH bb AS (SELECT l_orderkey AS sk_id_bureau, l_returnflag AS status, count(*) AS months FROM lineitem GROUP BY 1, 2), "
        "r AS (SELECT o.o_custkey AS sk_id_curr, o.o_orderkey AS sk_id_bureau, bb.status, "
        "CASE WHEN bb.status IN ('R') THEN 1.0 ELSE 0.0 END AS overdue FROM orders o LEFT JOIN bb ON o.o_orderkey = bb.sk_id_bureau), "
        "m AS (SELECT sk_id_curr, CASE WHEN count_if(status IS NULL) > 0 THEN count_if(status IS NULL) END AS bureau_miss_time FROM r GROUP BY 1), "
        "l1 AS (SELECT sk_id_curr, sk_id_bureau, avg(overdue) AS overdue_mean, coalesce(sum(overdue), 0) AS overdue_sum FROM r GROUP BY 1, 2), "
        "st AS (SELECT sk_id_curr, "
        + ", ".join(f"CAST(count_if(status = '{v.upper()}') AS BIGINT) AS balance_status_{v}" for v in flags)
        + ", CAST(count(*) AS BIGINT) AS status_total, "
        + ", ".join(f"{f32(f'count_if(status = {chr(39)}{v.upper()}{chr(39)}) / count(*)')} AS balance_status_{v}_rate" for v in flags)
        + " FROM r WHERE status IS NOT NULL GROUP BY 1), "
        f"ov AS (SELECT sk_id_curr, {', '.join(sel[2:])} FROM l1 GROUP BY sk_id_curr), "
        "sp AS (SELECT c_custkey AS sk_id_curr FROM customer) "
        "SELECT sp.sk_id_curr AS c_custkey, CAST(coalesce(m.bureau_miss_time, 0) AS BIGINT) AS bureau_miss_time, "
        + ", ".join(f"coalesce(ov.bureau_{c}_{fn}, 0) AS bureau_{c}_{fn}" for c in ["overdue_mean", "overdue_sum"] for fn in ["mean", "max", "std", "sum", "median"])
        + ", " + ", ".join(stat)
        + " FROM sp LEFT JOIN m ON sp.sk_id_curr = m.sk_id_curr LEFT JOIN ov ON sp.sk_id_curr = ov.sk_id_curr "
        "LEFT JOIN st ON sp.sk_id_curr = st.sk_id_curr"
    )


def q_bureau_block() -> str:
    rows = (
        "br AS (SELECT o_custkey AS sk_id_curr, o_orderkey AS sk_id_bureau, "
        "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' END AS credit_active, "
        f"CAST(CAST(o_orderdate AS DATE) - {ORDERS_REF} AS INTEGER) AS days_credit, "
        f"CAST(CAST(o_orderdate AS DATE) - {ORDERS_REF} AS INTEGER) + 30 * (o_orderkey % 13) AS days_credit_enddate, "
        "o_totalprice AS amt_credit_sum, CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END AS amt_credit_sum_debt, "
        "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0.0 END AS amt_credit_sum_overdue, "
        "nullif(o_totalprice / 12, 0) AS amt_annuity FROM orders), "
        "bf AS (SELECT *, CASE WHEN credit_active = 'Active' THEN 1 ELSE 0 END AS active_flag, "
        "CASE WHEN days_credit_enddate > 0 THEN 1 ELSE 0 END AS enddate_flag, "
        "CASE WHEN amt_credit_sum_overdue > 0 THEN 1 ELSE 0 END AS overdue_flag, "
        "CASE WHEN amt_credit_sum_debt > 0 THEN 1 ELSE 0 END AS using_flag FROM br), "
        "fz AS (SELECT sk_id_curr, credit_active, CAST(coalesce(days_credit_enddate, 0) AS DOUBLE) AS days_credit_enddate, "
        "CAST(coalesce(days_credit, 0) AS DOUBLE) AS days_credit, coalesce(amt_credit_sum, 0) AS amt_credit_sum, "
        "coalesce(amt_credit_sum_debt, 0) AS amt_credit_sum_debt, coalesce(amt_credit_sum_overdue, 0) AS amt_credit_sum_overdue, "
        "coalesce(amt_annuity, 0) AS amt_annuity FROM bf), "
        "fd AS (SELECT *, amt_credit_sum_debt / nullif(1 + amt_credit_sum, 0) AS amt_credit_debt_rate, "
        "amt_credit_sum - amt_credit_sum_debt AS amt_credit_debt_remain, "
        "amt_credit_sum_debt / nullif(1 + amt_annuity, 0) AS amt_credit_months FROM fz)"
    )
    flags = ["active_flag", "enddate_flag", "overdue_flag", "using_flag"]
    fl = ", ".join(f"{f32(f'avg({c})')} AS credit_{c}_mean, CAST(sum({c}) AS BIGINT) AS credit_{c}_sum, count({c}) AS credit_{c}_count" for c in flags)
    base = ["days_credit_enddate", "days_credit", "amt_credit_sum", "amt_credit_sum_debt", "amt_credit_sum_overdue", "amt_annuity"]
    six = ["min", "median", "max", "mean", "sum", "std"]
    act = "credit_active = 'Active'"
    cls = "NOT coalesce(credit_active = 'Active', false)"
    st = []
    for c in base + ["amt_credit_debt_rate", "amt_credit_debt_remain", "amt_credit_months"]:
        st += [f"{fagg(fn, c, act, None, 'double')} AS credit_active_{c}_{fn}" for fn in six]
    for c in base + ["amt_credit_debt_rate"]:
        st += [f"{fagg(fn, c, cls, None, 'double')} AS credit_closed_{c}_{fn}" for fn in six]
    names = [f"credit_{c}_{s_}" for c in flags for s_ in ("mean", "sum", "count")]
    names += ["bureau_total_customer_debt", "bureau_total_customer_credit", "bureau_total_customer_overdue", "bureau_debt_credit_ratio", "bureau_overdue_debt_ratio"]
    names += [f"credit_active_{c}_{fn}" for c in base + ["amt_credit_debt_rate", "amt_credit_debt_remain", "amt_credit_months"] for fn in six]
    names += [f"credit_closed_{c}_{fn}" for c in base + ["amt_credit_debt_rate"] for fn in six]
    return (
        f"WITH {rows}, "
        "ms AS (SELECT sk_id_curr, CAST(CASE WHEN count_if(credit_active IS NULL) > 0 THEN count_if(credit_active IS NULL) END AS BIGINT) "
        "AS credit_credit_active_miss_times FROM bf GROUP BY 1), "
        f"fs AS (SELECT sk_id_curr, {fl} FROM bf GROUP BY 1), "
        "tt AS (SELECT sk_id_curr, sum(amt_credit_sum_debt) AS d, sum(amt_credit_sum) AS c, sum(amt_credit_sum_overdue) AS v FROM bf GROUP BY 1), "
        f"tr AS (SELECT sk_id_curr, {f32('d')} AS bureau_total_customer_debt, {f32('c')} AS bureau_total_customer_credit, "
        f"{f32('v')} AS bureau_total_customer_overdue, {f32('d / nullif(1 + c, 0)')} AS bureau_debt_credit_ratio, "
        f"{f32('v / nullif(1 + d, 0)')} AS bureau_overdue_debt_ratio FROM tt), "
        f"ss AS (SELECT sk_id_curr, {', '.join(st)} FROM fd GROUP BY 1), "
        "sp AS (SELECT DISTINCT sk_id_curr FROM bf) "
        "SELECT sp.sk_id_curr AS c_custkey, CAST(coalesce(ms.credit_credit_active_miss_times, 0) AS BIGINT) AS credit_credit_active_miss_times, "
        + ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)
        + " FROM sp LEFT JOIN ms ON sp.sk_id_curr = ms.sk_id_curr LEFT JOIN fs ON sp.sk_id_curr = fs.sk_id_curr "
        "LEFT JOIN tr ON sp.sk_id_curr = tr.sk_id_curr LEFT JOIN ss ON sp.sk_id_curr = ss.sk_id_curr"
    )



def q_pos_block() -> str:
    basic = ["user_id"]
    for c in ["sk_dpd", "sk_dpd_def", "e_days", "sk_dpd_diff"]:
        for fn in ["mean", "median", "min", "max", "sum", "std"]:
            basic.append(f"{typed(fn, agg_sql(fn, c), 'int')} AS pos_{c}_{fn}")
    pos_rows = POS_ROWS.replace("pos_paid_late_tol FROM p0)", "pos_paid_late_tol, sk_dpd - (CASE WHEN event_type = 'error' THEN sk_dpd ELSE 0 END) AS sk_dpd_diff FROM p0)")
    lk = q_pos_last_k().split(" SELECT ", 1)[1]
    tr = q_trend_pos().split(" SELECT ", 1)[1]
    parts = {
        "bs": f"SELECT {', '.join(basic)} FROM p GROUP BY user_id",
        "lk": "SELECT " + lk,
        "tr": "SELECT " + tr,
    }
    last = (
        "l1 AS (SELECT user_id, e_days, avg(value) AS m, min(value) AS lo, max(value) AS hi, sum(value) AS s FROM p GROUP BY user_id, e_days), "
        "lr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY e_days DESC) AS rn FROM l1), "
        f"la AS (SELECT user_id, e_days AS pos_last_e_days, {f32('m')} AS pos_last_value_mean, {f32('lo')} AS pos_last_value_min, "
        f"{f32('hi')} AS pos_last_value_max, {f32('s')} AS pos_last_value_sum FROM lr WHERE rn = 1)"
    )
    spec = {
        "pos_paid_late": ["count", "sum", "mean"], "pos_paid_late_tol": ["sum", "mean"],
        "sk_dpd": ["sum", "mean", "max", "min", "std"], "sk_dpd_def": ["sum", "mean", "max", "min", "std"],
    }
    lsel = ["user_id"] + [f"{fagg(fn, c, None, None, POS_TYPES[c])} AS last_loan_{c}_{fn}" for c, fns in spec.items() for fn in fns]
    loan = (
        "r2 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn2 FROM p), "
        "nw AS (SELECT user_id, event_type FROM r2 WHERE rn2 = 1), "
        "lrows AS (SELECT p.* FROM p JOIN nw ON p.user_id = nw.user_id AND p.event_type = nw.event_type), "
        f"lo AS (SELECT {', '.join(lsel)} FROM lrows GROUP BY user_id)"
    )
    # every entity of the application table, 0 where it has no row
    names = [x.split(" AS ")[-1] for x in basic[1:]]
    return (
        f"WITH {pos_rows}, {POS_RANK}, bs AS ({parts['bs']}), lk AS ({parts['lk']}), tr AS ({parts['tr']}), {last}, {loan}, "
        "j AS (SELECT c_custkey AS user_id, " + ", ".join(f"bs.{c}" for c in names)
        + ", la.* EXCLUDE (user_id), lk.* EXCLUDE (user_id), tr.* EXCLUDE (user_id), lo.* EXCLUDE (user_id) "
        "FROM customer LEFT JOIN bs ON c_custkey = bs.user_id LEFT JOIN la ON c_custkey = la.user_id LEFT JOIN lk ON c_custkey = lk.user_id "
        "LEFT JOIN tr ON c_custkey = tr.user_id LEFT JOIN lo ON c_custkey = lo.user_id) "
        "SELECT user_id, coalesce(COLUMNS(* EXCLUDE (user_id)), 0) FROM j"
    )



def out_type(fn: str, src: str) -> str:
    """SQL type Spark gives an aggregate (mirror of ``typed``)."""
    if fn in COUNT_FNS:
        return "BIGINT"
    if fn in DOUBLE_FNS or src == "double":
        return "REAL"
    if fn == "sum":
        return "BIGINT"
    return "INTEGER" if src == "int" else "BIGINT"


def fill0(name: str, typ: str, src: str | None = None) -> str:
    e = f"coalesce({src or name}, 0)"
    return f"{f32(e)} AS {name}" if typ == "REAL" else f"CAST({e} AS {typ}) AS {name}"


def q_instalment_block() -> str:
    global RAW
    RAW = True
    try:
        mu_cte, lk_body = last_k_sql("r", "o_custkey", INS_SPEC, INS_TYPES, INS_K, ["i_version", "late_days", "over_amount"], lambda k, c, f: f"last_{k}_{c}_{f}")
        trends = [f"{trend_sql(c, 'rn - 1', f'rn <= {k}')} AS trend_{k}_{c}" for k in [10, 50, 100, 500] for c in ["late_days", "over_amount"]]
        basic_cols = {"i_due": "double", "i_paid": "double", "i_days_paid": "int", "i_days_due": "int", "l_linenumber": "int", "i_version": "int"}
        six = ["mean", "min", "max", "median", "sum", "std"]
        bsel, bnames = [], []
        for c, t in basic_cols.items():
            for fn in six:
                bsel.append(f"{fagg(fn, c, None, None, t)} AS ins_{c}_{fn}")
                bnames.append((f"ins_{c}_{fn}", out_type(fn, t)))
        nine = ["sum", "mean", "median", "min", "max", "std", "iqr", "skew", "kurt"]
        for c, t in [("late_days", "int"), ("over_amount", "double")]:
            for fn in nine:
                bsel.append(f"{fagg(fn, c, None, 'mu_' + c, t)} AS {c}_{fn}")
                bnames.append((f"{c}_{fn}", out_type(fn, t)))
        for c in ["paid_late", "paid_over"]:
            for fn in ["sum", "mean", "count"]:
                bsel.append(f"{fagg(fn, c, None, None, 'int')} AS {c}_{fn}")
                bnames.append((f"{c}_{fn}", out_type(fn, "int")))
        psel, pnames = [], []
        for c in ["pay_long", "pay_long_amount"]:
            for fn in ["min", "median", "max", "mean", "sum", "std"]:
                psel.append(f"{typed(fn, agg_sql(fn, c), 'double')} AS ins_{c}_{fn}")
                pnames.append((f"ins_{c}_{fn}", "REAL"))
    finally:
        RAW = False
    lknames = [(f"last_{k}_{c}_{fn}", out_type(fn, INS_TYPES[c])) for k in INS_K for c, fns in INS_SPEC.items() for fn in fns]
    trnames = [(f"trend_{k}_{c}", "REAL") for k in [10, 50, 100, 500] for c in ["late_days", "over_amount"]]
    frac = []
    for s_, l_ in [(5, 20), (5, 50), (10, 100)]:
        for c, fns in INS_SPEC.items():
            for fn in fns:
                a, b = f"CAST(lk.last_{s_}_{c}_{fn} AS DOUBLE)", f"CAST(lk.last_{l_}_{c}_{fn} AS DOUBLE)"
                frac.append((f"last_{s_}by{l_}_fraction_{c}_{fn}", f"CASE WHEN abs({b}) < 1e-9 THEN 0.0 ELSE {a} / {b} END"))
    final = ["bs.o_custkey AS c_custkey"]
    final += [fill0(n, t, f"bs.{n}") for n, t in bnames]
    final += [fill0(n, t, f"pl.{n}") for n, t in pnames]
    final += [fill0(n, t, f"lk.{n}") for n, t in lknames]
    final += [fill0(n, t, f"lk.{n}") for n, t in trnames]
    final += [f"{f32(f'coalesce({e}, 0)')} AS {n}" for n, e in frac]
    return (
        f"WITH {INS_ROWS}, {INS_RANK}{mu_cte}, "
        f"lk0 AS ({lk_body}), tr AS (SELECT o_custkey, {', '.join(trends)} FROM r GROUP BY o_custkey), "
        "lk AS (SELECT lk0.*, tr.* EXCLUDE (o_custkey) FROM lk0 JOIN tr ON lk0.o_custkey = tr.o_custkey), "
        "im AS (SELECT *, avg(late_days) OVER (PARTITION BY o_custkey) AS mu_late_days, avg(over_amount) OVER (PARTITION BY o_custkey) AS mu_over_amount FROM i), "
        f"bs AS (SELECT o_custkey, {', '.join(bsel)} FROM im GROUP BY o_custkey), "
        + DEDUP_FIRST + ", "
        "n AS (SELECT *, CAST(coalesce(LEAD(l_linenumber) OVER (PARTITION BY o_custkey, l_orderkey ORDER BY l_linenumber, i_version, i_paid) "
        "- l_linenumber, 1) AS DOUBLE) AS pay_long FROM d), "
        "q AS (SELECT o_custkey, pay_long, i_paid * pay_long AS pay_long_amount FROM n), "
        f"pl AS (SELECT o_custkey, {', '.join(psel)} FROM q GROUP BY o_custkey) "
        f"SELECT {', '.join(final)} FROM bs LEFT JOIN pl ON bs.o_custkey = pl.o_custkey LEFT JOIN lk ON bs.o_custkey = lk.o_custkey"
    )



def q_card_block() -> str:
    """Written from the reference's steps: a level-1 and a level-2 aggregate per row set."""
    global RAW
    ratio = lambda a, b: f"CAST({a} AS DOUBLE) / nullif(1 + {b}, 0)"
    rows = POS_ROWS + (
        f", c AS ({CARD_TABLE}), dv AS (SELECT *, amt_recivable - amt_receivable_principal AS amt_receivable_diff, "
        "amt_credit_limit_actual - amt_balance AS amt_balance_diff, amt_credit_limit_actual - amt_drawings_current AS amt_drawings_diff, "
        f"{ratio('amt_drawings_current', 'amt_credit_limit_actual')} AS amt_credit_ratio, {ratio('amt_balance', 'amt_credit_limit_actual')} AS amt_balance_ratio, "
        f"{ratio('amt_recivable', 'amt_balance')} AS amt_receivable_ratio FROM c)"
    )
    six = ["mean", "min", "max", "median", "sum", "std"]
    amt = ["amt_balance", "amt_credit_limit_actual", "amt_drawings_current", "amt_payment_current", "amt_payment_total_current", "amt_receivable_principal", "amt_recivable"]
    derived = ["amt_receivable_diff", "amt_balance_diff", "amt_drawings_diff", "amt_credit_ratio", "amt_balance_ratio", "amt_receivable_ratio"]
    year = ["amt_balance", "amt_credit_limit_actual", "amt_drawings_current", "amt_payment_current", "amt_receivable_principal", "cnt_drawings_current", "sk_dpd", "sk_dpd_def", "amt_balance_ratio"]
    whole = {"cnt_drawings_current", "sk_dpd", "sk_dpd_def"}
    every = [*amt, "cnt_drawings_current", *derived]
    active = "name_contract_status = 'Active'"
    sets = [
        ("all", "true", every), ("using", "amt_payment_total_current <> 0 OR amt_payment_total_current IS NULL", every),
        ("2_year", f"months_balance >= -24 AND {active}", year), ("1_year", f"months_balance >= -12 AND {active}", year),
    ]
    sql_type = {"REAL": "double", "INTEGER": "int", "BIGINT": "bigint"}
    ctes, final = [], []
    for tag, where, feats in sets:
        RAW = True
        try:
            l1 = [f"{typed(fn, agg_sql(fn, c), 'int' if c in whole else 'double')} AS {c}_{fn}" for c in feats for fn in six]
        finally:
            RAW = False
        l2 = []
        for c in feats:
            for f1 in six:
                t = sql_type[out_type(f1, "int" if c in whole else "double")]
                for f2 in six:
                    name = f"card_{tag}_{c}_{f1}_{f2}"
                    l2.append(f"{typed(f2, agg_sql(f2, f'{c}_{f1}'), t)} AS {name}")
                    final.append((name, out_type(f2, t), f"s_{tag}.{name}"))
        ctes.append(f"l_{tag} AS (SELECT sk_id_curr, sk_id_prev, {', '.join(l1)} FROM dv WHERE {where} GROUP BY 1, 2)")
        ctes.append(f"s_{tag} AS (SELECT sk_id_curr, {', '.join(l2)} FROM l_{tag} GROUP BY 1)")
    pay = "amt_payment_total_current"
    RAW = True
    try:
        f1 = [f"{typed(fn, agg_sql(fn, pay), 'double')} AS {pay}_{fn}" for fn in ["max", "min", "median", "mean", "sum", "std"]]
    finally:
        RAW = False
    first = [(f"card_first_time_{pay}_{a}_{b}", a, b) for a in ["max", "min", "median", "mean", "sum", "std"] for b in ["mean", "min", "max", "sum", "std", "median"]]
    ctes.append(f"pd AS (SELECT DISTINCT sk_id_curr, sk_id_prev, {pay} FROM c WHERE {pay} <> 0 OR {pay} IS NULL)")
    ctes.append(f"pl AS (SELECT sk_id_curr, sk_id_prev, {', '.join(f1)} FROM pd GROUP BY 1, 2)")
    ctes.append("ft AS (SELECT sk_id_curr, " + ", ".join(f"{typed(b, agg_sql(b, f'{pay}_{a}'), 'double')} AS {n}" for n, a, b in first) + " FROM pl GROUP BY 1)")
    final += [(n, "REAL", f"ft.{n}") for n, _, _ in first]
    flags = {"out_overdue_flag": "sk_dpd - sk_dpd_def > 0", "using_flag": "amt_balance > 0"}
    own = []
    for f, cond in flags.items():
        e = f"CASE WHEN {cond} THEN 1 ELSE 0 END"
        for fn in ["mean", "sum", "count"]:
            own.append((f"card_{f}_{fn}", out_type(fn, "int"), typed(fn, agg_sql(fn, e), "int")))
    for x, e in {"sk_out": "CAST(sk_dpd - sk_dpd_def AS DOUBLE)", "sk_dpd_def": "CAST(sk_dpd_def AS DOUBLE)", "sk_dpd": "CAST(sk_dpd AS DOUBLE)"}.items():
        for fn in ["median", "mean", "sum", "max", "std"]:
            own.append((f"{x}_{fn}", "REAL", typed(fn, agg_sql(fn, e), "double")))
    for m in ["amt_drawings_current", pay]:
        own.append((f"creditcard_{m}_miss_times", "BIGINT", f"nullif(count_if({m} IS NULL), 0)"))
    ctes.append("ow AS (SELECT sk_id_curr, " + ", ".join(f"{e} AS {n}" for n, _, e in own) + " FROM c GROUP BY 1)")
    final += [(n, t, f"ow.{n}") for n, t, _ in own]
    return (
        f"WITH {rows}, {', '.join(ctes)} SELECT c_custkey AS sk_id_curr, " + ", ".join(fill0(n, t, e) for n, t, e in final)
        + " FROM customer " + " ".join(f"LEFT JOIN {t} ON c_custkey = {t}.sk_id_curr" for t in ["ow", "ft", *[f"s_{tag}" for tag, _, _ in sets]])
    )


def q_previous_block() -> str:
    guarded = lambda a, b: f"{a} / nullif(1 + {b}, 0)"
    base_amt = ["amt_annuity", "amt_application", "amt_credit", "amt_down_payment", "amt_goods_price", "rate_down_payment", "cnt_payment"]
    base_day = ["days_first_due", "days_last_due_1st_version", "days_last_due", "days_termination", "days_decision"]
    amounts = {
        **{c: c for c in base_amt}, "amt_min_year": guarded("amt_credit", "amt_annuity"), "amt_credit_trust": "amt_credit - amt_application",
        "amt_credit_ratio": guarded("amt_credit", "amt_application"), "amt_goods_ratio": guarded("amt_credit", "amt_goods_price"),
        "amt_goods_remain": "amt_credit - amt_goods_price",
    }
    days = {
        **{c: c for c in base_day}, "days_due_diff": "days_last_due - days_first_due", "days_last_due_diff": "days_last_due_1st_version - days_last_due",
        "days_waiting_diff": "days_first_due - days_decision", "days_origin_due_diff": "days_last_due_1st_version - days_first_due",
        "days_origin_que_diff": "days_termination - days_last_due",
    }
    d1 = "d1 AS (SELECT sk_id_curr, name_contract_status, " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in [*amounts.items(), *days.items()]) + " FROM pr)"
    five = ["min", "median", "max", "mean", "std"]
    st = []
    for tag, w, day_fns in [("", None, five), ("approved_", "name_contract_status = 'Approved'", [*five, "sum"]), ("refused_", "name_contract_status = 'Refused'", five)]:
        st += [(f"prev_{tag}{c}_{fn}", fagg(fn, c, w)) for c in amounts for fn in five]
        st += [(f"prev_{tag}{c}_{fn}", fagg(fn, c, w)) for c in days for fn in day_fns]
    miss = [c for c in base_amt + base_day if c not in ("amt_annuity", "amt_application", "amt_credit", "days_first_due", "days_decision", "amt_goods_price")]
    cat = [(f"prev_{c}_{san(v)}", f"nullif(count_if({c} = '{v}'), 0)") for c, vs in PREV_VALUES.items() for v in vs]
    term = {"cnt_payment": "term_of", "days_decision": "days_decision_about", "days_first_drawing": "days_first_drawing"}
    lk = [(f"previous_application_{t}_last_{k}_credits_mean", f32(f"avg({c}) FILTER (WHERE rn <= {k})")) for k in [1, 3, 5] for c, t in term.items()]
    names = [(f"prev_{c}_miss_times", "BIGINT", f"ms.prev_{c}_miss_times") for c in miss]
    names += [(n, "REAL", f"ss.{n}") for n, _ in st] + [(n, "BIGINT", f"ct.{n}") for n, _ in cat] + [(n, "REAL", f"lk.{n}") for n, _ in lk]
    return (
        f"WITH {PREV_TABLE}, {d1}, "
        f"ms AS (SELECT sk_id_curr, {', '.join(f'nullif(count_if({c} IS NULL), 0) AS prev_{c}_miss_times' for c in miss)} FROM pr GROUP BY 1), "
        f"ss AS (SELECT sk_id_curr, {', '.join(f'{e} AS {n}' for n, e in st)} FROM d1 GROUP BY 1), "
        f"ct AS (SELECT sk_id_curr, {', '.join(f'{e} AS {n}' for n, e in cat)} FROM pr GROUP BY 1), "
        "rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sk_id_curr ORDER BY days_decision DESC, sk_id_prev DESC) AS rn FROM pr), "
        f"lk AS (SELECT sk_id_curr, {', '.join(f'{e} AS {n}' for n, e in lk)} FROM rk GROUP BY 1) "
        "SELECT c_custkey, " + ", ".join(fill0(n, t, e) for n, t, e in names)
        + " FROM customer " + " ".join(f"LEFT JOIN {t} ON c_custkey = {t}.sk_id_curr" for t in ["ms", "ss", "ct", "lk"])
    )


ORACLES = {
    "flagship_order_activity": q_flagship,
    "a22_naive_slices": q_flagship,
    "a01_a12_functions": q_functions,
    "a13_first_valid": q_first_valid,
    "a14_category_share": q_share,
    "a23_category_slices": q_category_slices,
    "a24_two_level": q_two_level,
    "a25_missing_counts": q_missing,
    "a26_totals_ratio": q_totals,
    "a27_category_counts": q_category_counts,
    "a28_status_rates": q_status_rates,
    "a30_latest_period": q_latest_period,
    "a32_flag_stats": q_flag_stats,
    "a15_global_stats": q_global,
    "j2_validated_join": q_validated,
    "j5_label_propagation": q_label,
    "j8_name_collision": q_collision,
    "w3_last_k_instalments": q_last_k,
    "w8_last_k_fractions": q_fractions,
    "w7_trend_instalments": q_trend_ins,
    "w4_pos_last_k": q_pos_last_k,
    "w7_trend_pos": q_trend_pos,
    "w6_latest_loan": q_latest_loan,
    "w5_tail_k_contracts": q_tail_k,
    "w2_prolongation": q_prolongation,
    "w9_dedup_first": q_dedup_first,
    "w10_dedup_last": q_dedup_last,
    "w1_lag_usage": q_lag,
    "e1_one_hot": q_one_hot,
    "e2_target_encoding": q_target,
    "e3_child_target_encoding": q_child_target,
    "e4_woe": q_woe,
    "e5_factorize": q_factorize,
    "e6_value_map": q_value_map,
    "f1_corr_prune": q_corr,
    "f1_corr_prune_gram": q_corr,
    "f2_ranked_prune": q_ranked,
    "f3_importance": q_importance,
    "m6_auc": q_auc,
    "m6_auc_by_group": q_auc_group,
    "m7_gini": q_gini,
    "m8_blend": q_blend,
    "o3_top40_by_mean": q_top40,
    "u1_union_by_name": q_union,
    "p_application_features": q_application,
    "p_scrub_fill": q_scrub,
    "p31_narrow_types": q_narrow,
    "p32_type_split": q_type_split,
    "p33_binary_columns": q_binary,
    "s1_s6_csv_roundtrip": q_csv,
    "s2_capped_scan": q_capped,
    "s3_projected_scan": q_projected,
    "s5_s7_ranked_list": q_ranked_list,
    "x1_grouped_udf": q_grouped,
    "b46_kernel_pos": q_k_pos,
    "b47_kernel_instalments": q_k_ins,
    "b48_kernel_cards": q_k_cards,
    "a06_quantiles_rank_mode": q_rank_quantiles,
    "p07_p08_global_fills": q_global_fills,
    "b43_kernel_application": q_k_app,
    "b45_kernel_previous": q_k_prev,
    "b44_kernel_bureau": q_k_bureau,
    "b10_balance_block_unpruned": q_balance_block,
    "b04_bureau_block_unpruned": q_bureau_block,
    "b29_pos_block_unpruned": q_pos_block,
    "b22_instalment_block_unpruned": q_instalment_block,
    "b14_card_block_unpruned": q_card_block,
    "b35_previous_block_unpruned": q_previous_block,
    "w1_lag_usage_rank": q_lag,
    "m1_split_tag_union": q_split,
    "b01_load_split": q_load_split,
    "m2_kfold": q_kfold,
    "m3_stratified_kfold": q_stratified,
    "s4_exact_sample": q_sample,
}


def oracle_sql() -> dict[str, str]:
    return {k: fn() for k, fn in ORACLES.items()}
