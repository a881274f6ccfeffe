"""Spec-driven grouped aggregation.

The reference computes every status slice, recency window and category slice
as its own filter -> groupby -> left join. Here all slices of one table fuse
into one ``groupBy(key).agg(...)``: one exchange on the entity key, with every
aggregate partially combined map-side before the shuffle, so a hot key never
ships its raw rows to one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfeat.functions import aggfns
from loomfeat.functions.exprs import col
from loomfeat.operators import sorted_groups
from loomfeat.operators.joins import null_safe_join

Spec = Mapping[str, Sequence]  # {column: [fn name | (name, builder)]}


@dataclass(frozen=True)
class Slice:
    """A named row subset: status slice (A21), recency window (A22), category."""

    tag: str
    where: Column | None = None
    sql: str | None = None  # the same predicate as SQL text, when available (faster plan building)


ALL = Slice("", None)


def and_slices(a: Slice, b: Slice, sep: str = "_") -> Slice:
    """Combine two slices, e.g. status 'act' x window '1y' -> 'act_1y'."""
    tag = sep.join(t for t in (a.tag, b.tag) if t)
    if a.where is None:
        return Slice(tag, b.where, b.sql)
    if b.where is None:
        return Slice(tag, a.where, a.sql)
    sql = f"({a.sql}) AND ({b.sql})" if a.sql and b.sql else None
    return Slice(tag, a.where & b.where, sql)


def eq_slice(tag: str, column: str, value) -> Slice:
    """Rows whose ``column`` equals ``value`` (NULL never matches)."""
    return Slice(tag, F.col(column) == F.lit(value), f"`{column}` = {aggfns.sql_literal(value)}")


def window_slices(offset_col: str, windows: Mapping[str, int]) -> list[Slice]:
    """``offset >= -w`` slices, e.g. ``{'1y': 365, '2y': 730}``."""
    return [Slice(tag, F.col(offset_col) >= F.lit(-abs(w)), f"`{offset_col}` >= {-abs(int(w))}") for tag, w in windows.items()]


def value_slices(cat_col: str, values: Iterable, tag_fn: Callable[[object], str] | None = None) -> list[Slice]:
    """One slice per category value."""
    tag_fn = tag_fn or (lambda v: sanitize(str(v)))
    return [Slice(tag_fn(v), F.col(cat_col).eqNullSafe(F.lit(v)), f"`{cat_col}` <=> {aggfns.sql_literal(v)}") for v in values]


def sanitize(name: str) -> str:
    """Deterministic, SQL-safe column-name fragment."""
    out = "".join(ch.lower() if ch.isalnum() else "_" for ch in name)
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_") or "empty"


def default_namer(prefix: str, column: str, tag: str, fn: str) -> str:
    return f"{prefix}{column}{'_' + tag if tag else ''}_{fn}"


def agg_exprs(
    spec: Spec,
    slices: Sequence[Slice] = (ALL,),
    prefix: str = "",
    namer: Callable[[str, str, str, str], str] = default_namer,
    shifts: Mapping[str, Column | str] | None = None,
) -> list[Column]:
    """Aggregate Columns for ``spec`` x ``slices``, named by ``namer``.

    ``shifts`` maps a column to a per-group reference value; skew/kurt of that
    column are then computed from shared power sums instead of one
    central-moment buffer each (far less generated code for wide specs).
    """
    shifts = shifts or {}
    out = []
    for s in slices:
        for c, fns in spec.items():
            for fn in fns:
                name, build = aggfns.resolve(fn)
                text_ok = isinstance(shifts.get(c), str) and (s.where is None or s.sql is not None)
                if text_ok and fn in ("skew", "kurt"):
                    out.append(aggfns.moment_sql(fn, c, shifts[c], s.sql).alias(namer(prefix, c, s.tag, name)))
                    continue
                if isinstance(fn, str) and fn in aggfns.TEXT_FNS and not (c in shifts and fn in ("skew", "kurt")) and (s.where is None or s.sql is not None):
                    out.append(aggfns.agg_text(fn, c, s.sql).alias(namer(prefix, c, s.tag, name)))
                    continue
                shift = shifts.get(c)
                shift = F.col(shift) if isinstance(shift, str) else shift
                if shift is not None and fn == "skew":
                    build = aggfns.skew_from_shift(shift)
                elif shift is not None and fn == "kurt":
                    build = aggfns.kurt_from_shift(shift)
                out.append(build(F.col(c), s.where).alias(namer(prefix, c, s.tag, name)))
    return out


def slice_guard(where: Column) -> Column:
    return F.count_if(F.coalesce(where, F.lit(False)))


def distinct_counts(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    slices: Sequence[Slice],
    names: Sequence[str],
) -> DataFrame:
    """A9 per slice without row expansion: distinct (key, value) pairs first (a partial
    aggregate keyed by key and value, so a hot key spreads over tasks), then a count per key.
    A key with no row in a slice gets NULL (N3) through the guard in ``aggregate``."""
    flags = [(s.where if s.where is not None else F.lit(True)) for s in slices]
    pairs = (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys, column)
        .agg(*[F.max(F.coalesce(f, F.lit(False)).cast("int")).alias(f"__d{i}") for i, f in enumerate(flags)])
    )
    return pairs.groupBy(*keys).agg(*[F.sum(f"__d{i}").alias(n) for i, n in enumerate(names)])


def _slice_id(s: Slice) -> str:
    """Equal for slices that are known to select the same rows."""
    return "" if s.where is None else s.sql or f"#{id(s.where)}"


@dataclass(frozen=True)
class Part:
    """One specification of a fused aggregate: columns and functions, over slices, with its names."""

    spec: Spec
    slices: Sequence[Slice] = (ALL,)
    prefix: str = ""
    namer: Callable[[str, str, str, str], str] = default_namer


def aggregate(
    df: DataFrame,
    keys: str | Sequence[str],
    spec: Spec,
    slices: Sequence[Slice] = (ALL,),
    prefix: str = "",
    namer: Callable[[str, str, str, str], str] = default_namer,
    size_name: str | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One fused grouped aggregate over all slices.

    ``size_name`` adds the group row count (``INS_COUNT``-style, A31).
    """
    if size_name:
        extra = [F.count(F.lit(1)).alias(size_name), *extra]
    return aggregate_parts(df, keys, [Part(spec, slices, prefix, namer)], extra)


#: From this number of statistics on, sorted groups are cheaper than buffers.
WIDE = 60
_HELD_TYPES = {"byte", "short", "integer", "float", "double"}  # whose values and sums of a group are exact as doubles


def aggregate_parts(df: DataFrame, keys: str | Sequence[str], parts: Sequence[Part], extra: Sequence[Column] = (), group_rows: int = sorted_groups.GROUP_ROWS) -> DataFrame:
    """Several specifications of one table together: columns come in the order of the parts, then ``extra``.

    ``WIDE`` or more statistics of numeric columns are taken from rows sorted by their group
    (``sorted_groups``) where a group has up to ``group_rows`` rows; fewer of them, larger
    groups and all other functions are one grouped aggregate (``_aggregate_fused``).
    Rows with a NULL key are one group.
    """
    keys, extra = [keys] if isinstance(keys, str) else list(keys), list(extra)
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def held(c: str, f) -> bool:
        return isinstance(f, str) and f in sorted_groups.FUNCTIONS and kinds.get(c) in _HELD_TYPES

    wheres: dict[str, Column | None] = {}
    order = [(p.namer(p.prefix, c, s.tag, aggfns.resolve(f)[0]), c, wheres.setdefault(_slice_id(s), s.where), f) for p in parts for s in p.slices for c, fns in p.spec.items() for f in fns]
    if sum(held(c, f) for _, c, _, f in order) < WIDE or not keys:
        return _aggregate_fused(df, keys, parts, extra)
    large = sorted_groups.large_groups(df, keys, group_rows)
    if large is not None:
        small = _aggregate_sorted(null_safe_join(df, large, keys, "left_anti"), keys, parts, extra, order, held, kinds)
        return small.unionByName(_aggregate_fused(null_safe_join(df, large, keys, "left_semi"), keys, parts, extra))
    return _aggregate_sorted(df, keys, parts, extra, order, held, kinds)


def _aggregate_sorted(df: DataFrame, keys: list[str], parts: Sequence[Part], extra: list[Column], order: list[tuple], held: Callable, kinds: Mapping[str, str]) -> DataFrame:
    items = [(f"__s{i}", F.col(c), where, f) for i, (_, c, where, f) in enumerate(order) if held(c, f)]
    out = sorted_groups.statistics(df, keys, items)
    rest = [Part({c: [f for f in fns if not held(c, f)] for c, fns in p.spec.items()}, p.slices, p.prefix, p.namer) for p in parts]
    extra_names: list[str] = []
    if extra or len(items) < len(order):
        main = _aggregate_fused(df, keys, [Part({c: fns for c, fns in p.spec.items() if fns}, p.slices, p.prefix, p.namer) for p in rest], extra)
        own = {name for name, c, _, f in order if not held(c, f)}
        extra_names = [c for c in main.columns if c not in keys and c not in own]
        out = null_safe_join(out, main, keys, "inner")

    def value(i: int, name: str, c: str, f) -> str:
        if not held(c, f):
            return f"`{name}`"
        if f in ("min", "max"):
            return f"CAST(__s{i} AS {df.schema[c].dataType.simpleString()})"
        return f"CAST(__s{i} AS BIGINT)" if f == "sum" and kinds[c] in ("byte", "short", "integer") else f"__s{i}"

    # as text: one call to the JVM for hundreds of columns
    return out.selectExpr(*[f"`{k}`" for k in keys], *[f"{value(i, name, c, f)} AS `{name}`" for i, (name, c, _, f) in enumerate(order)], *[f"`{c}`" for c in extra_names])


def _aggregate_fused(df: DataFrame, keys: str | Sequence[str], parts: Sequence[Part], extra: Sequence[Column] = ()) -> DataFrame:
    """One grouped aggregate: one scan, one exchange on the keys, partial sums before it.

    What would hold a group's values in one task is computed beside it, from a scan of its
    own: ``nunique`` from distinct (key, value) pairs (no Expand of every row), and every
    ``median`` and ``iqr`` together in one ``quantiles.exact_quantiles`` (one item per column
    and slice).
    """
    from loomfeat.operators.quantiles import exact_quantiles

    keys = [keys] if isinstance(keys, str) else list(keys)
    side_fns = ("nunique", "median", "iqr")
    exprs, order, slices = [], [], {}
    distinct: dict[tuple[str, str], str] = {}
    quant: dict[tuple[str, str], str] = {}
    spreads: set[tuple[str, str]] = set()
    for p in parts:
        rest = {c: [f for f in fns if f not in side_fns] for c, fns in p.spec.items()}
        exprs += agg_exprs({c: fns for c, fns in rest.items() if fns}, p.slices, p.prefix, p.namer)
        for s in p.slices:
            at = _slice_id(s)
            slices.setdefault(at, s.where)
            for c, fns in p.spec.items():
                order += [(p.namer(p.prefix, c, s.tag, aggfns.resolve(f)[0]), f, (c, at)) for f in fns]
                if "nunique" in fns:
                    distinct.setdefault((c, at), f"__u{len(distinct)}")
                if "median" in fns or "iqr" in fns:
                    quant.setdefault((c, at), f"__q{len(quant)}")
                if "iqr" in fns:
                    spreads.add((c, at))
    extra = list(extra)
    if not distinct and not quant:
        return df.groupBy(*keys).agg(*exprs, *extra)

    rows_in = {at: f"__n{i}" for i, at in enumerate({at: None for _, at in [*distinct, *sorted(spreads)]})}
    main = df.groupBy(*keys).agg(
        *exprs,
        *extra,
        *[(F.count(F.lit(1)) if slices[at] is None else slice_guard(slices[at])).alias(name) for at, name in rows_in.items()],
        *[F.count(F.col(c) if slices[at] is None else F.when(slices[at], F.col(c))).alias(f"{name}__c") for (c, at), name in quant.items() if (c, at) in spreads],
    )
    named = {n for n, *_ in order}
    extra_names = [c for c in main.columns if c not in keys and not c.startswith("__") and c not in named]
    # the side frames are keyed by the same keys: the joins need no further exchange of main
    for c in {c: None for c, _ in distinct}:
        own = [(at, name) for (col_, at), name in distinct.items() if col_ == c]
        side = distinct_counts(df, keys, c, [Slice("", slices[at]) for at, _ in own], [name for _, name in own])
        main = null_safe_join(main, side, keys)
    if quant:
        items = [(name, F.col(c), slices[at]) for (c, at), name in quant.items()]
        only = {name: (0, 1, 2) if at in spreads else (1,) for at, name in quant.items()}
        main = null_safe_join(main, exact_quantiles(df, keys, items, aggfns.QUARTILES, only), keys)

    def value(name: str, f, where: tuple[str, str]) -> Column:
        if f == "nunique":
            n = F.coalesce(F.col(distinct[where]), F.lit(0)).cast("long")
            return n if slices[where[1]] is None else F.when(F.col(rows_in[where[1]]) > 0, n)
        if f == "median":
            return F.col(f"{quant[where]}__q1")
        if f == "iqr":
            q = quant[where]
            return F.when(F.col(f"{q}__c") == F.col(rows_in[where[1]]), F.col(f"{q}__q2") - F.col(f"{q}__q0"))
        return F.col(f"`{name}`")

    return main.select(*[F.col(k) for k in keys], *[value(*o).alias(o[0]) for o in order], *[F.col(f"`{c}`") for c in extra_names])


def aggregate_naive(
    df: DataFrame,
    keys: str | Sequence[str],
    spec: Spec,
    slices: Sequence[Slice] = (ALL,),
    prefix: str = "",
    namer: Callable[[str, str, str, str], str] = default_namer,
) -> DataFrame:
    """The reference's shape: filter -> aggregate -> left join, once per slice.

    Kept only as the baseline the fused form is measured and tested against.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.select(*keys).distinct()
    for s in slices:
        part = df if s.where is None else df.filter(s.where)
        part = part.groupBy(*keys).agg(*agg_exprs(spec, [Slice(s.tag)], prefix, namer))
        out = out.join(part, keys, "left")
    return out


def two_level(
    df: DataFrame,
    outer: str,
    inner: str | Sequence[str],
    inner_spec: Spec,
    outer_fns: Sequence,
    prefix: str = "",
    inner_namer: Callable[[str, str, str, str], str] = default_namer,
    outer_namer: Callable[[str, str, str, str], str] = default_namer,
) -> DataFrame:
    """Aggregate per (outer, inner), then aggregate those values per outer.

    Names concatenate: ``<prefix><col>_<fn1>_<fn2>``. The inner aggregate is
    keyed by a superset of the outer key; Spark plans two exchanges, the first
    one partially aggregated, so both levels are hot-key safe.
    """
    inner = [inner] if isinstance(inner, str) else list(inner)
    lvl1 = aggregate(df, [outer, *inner], inner_spec, namer=inner_namer)
    lvl1_cols = [c for c in lvl1.columns if c not in (outer, *inner)]
    spec2 = {c: list(outer_fns) for c in lvl1_cols}
    return aggregate(lvl1, outer, spec2, prefix=prefix, namer=outer_namer)


def category_domain(df: DataFrame, cat_col: str, max_values: int = 10_000) -> list:
    """Sorted non-NULL domain of a categorical column (dynamic columns, E1/A25/A27).

    Only the distinct values are collected, never rows: every value becomes a column of
    the plan, so the caller chooses a column of few values; more than ``max_values`` raise.
    """
    vals = df.select(cat_col).where(F.col(cat_col).isNotNull()).distinct().limit(max_values + 1).collect()
    if len(vals) > max_values:
        raise ValueError(f"{cat_col} has more than {max_values} distinct values; refusing to pivot")
    return sorted(r[0] for r in vals)


def category_domains(df: DataFrame, columns: Sequence[str], max_values: int = 10_000) -> dict[str, list[str]]:
    """Sorted non-NULL values, as text, of several categorical columns in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    found = df.select(F.explode(cells).alias("x")).select("x.c", "x.v").where("v IS NOT NULL").distinct().limit(max_values + 1).collect()
    if len(found) > max_values:
        raise ValueError(f"the columns have more than {max_values} distinct values")
    return {c: sorted(r.v for r in found if r.c == c) for c in columns}


def category_counts(
    df: DataFrame,
    key: str,
    cat_col: str,
    values: Sequence | None = None,
    prefix: str = "",
    with_rates: bool = False,
    total_name: str = "status_total",
    absent_as_null: bool = False,
) -> DataFrame:
    """Count of rows per (key, category value) as columns.

    NULL categories are dropped (pandas groupby, N7). A value absent for a key
    counts 0, or NULL with ``absent_as_null`` (the unstacked frame before its
    fill). With ``with_rates`` a row total and a per-value share of it are
    added (A28; absent values count 0 there, as the reference fills first).
    """
    if values is None:
        values = category_domain(df, cat_col)
    names = [f"{prefix}{sanitize(str(v))}" for v in values]
    def count(v):
        n = F.count_if(F.col(cat_col) == F.lit(v))
        return F.when(n > 0, n) if absent_as_null and not with_rates else n

    exprs = [count(v).alias(n) for v, n in zip(values, names)]
    out = df.where(F.col(cat_col).isNotNull()).groupBy(key).agg(*exprs)
    if with_rates:
        out = out.withColumn(total_name, sum((F.col(n) for n in names), F.lit(0)))
        out = out.select(
            "*", *[F.try_divide(F.col(n).cast("double"), F.col(total_name).cast("double")).alias(f"{n}_rate") for n in names]
        )
    return out


def category_counts_many(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    name: Callable[[str, str], str],
    max_values: int = 10_000,
) -> DataFrame:
    """A27 for many columns at once: a row per key, NULL where a key lacks a value.

    Rows become (key, column, value) and are counted in one exchange; the counts are written
    once, give the domains of all columns and are then turned into columns by the key. More
    than ``max_values`` values of all columns together raise: each becomes a column.
    """
    from loomfeat.session import written

    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    counts = df.select(key, F.explode(cells).alias("x")).select(key, "x.c", "x.v").where("v IS NOT NULL")
    counts = written(counts.groupBy(key, "c", "v").agg(F.count(F.lit(1)).alias("n")), "category-counts")
    domain = counts.select("c", "v").distinct().limit(max_values + 1).collect()
    if len(domain) > max_values:
        raise ValueError(f"the columns have more than {max_values} distinct values; refusing to pivot")
    place = {c: i for i, c in enumerate(columns)}
    domain = sorted((place[r.c], r.v) for r in domain)
    n = [F.max(F.when((F.col("c") == columns[i]) & (F.col("v") == v), F.col("n"))).alias(name(columns[i], v)) for i, v in domain]
    return counts.groupBy(key).agg(*n) if n else counts.select(key).distinct()


def missing_counts(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    prefix: str = "",
    suffix: str = "_miss_times",
    only_with_nulls: bool = True,
) -> DataFrame:
    """Per key, number of rows where a column is NULL, for columns that have any NULL.

    One grouped pass counts the NULLs of every candidate column per key; the
    small per-key result is checkpointed and tells which columns have a NULL
    at all (no second scan of the child table). A key without NULL gets NULL
    (it is absent in the reference's per-column join); fill later where the
    reference does.
    """
    columns = [c for c in (columns or df.columns) if c != key]
    if not columns:
        return df.select(key).distinct()
    names = {c: f"{prefix}{c}{suffix}" for c in columns}
    exprs = []
    for c in columns:
        n = F.count_if(F.col(c).isNull())
        exprs.append(F.when(n > 0, n).alias(names[c]))
    per_key = df.groupBy(key).agg(*exprs)
    if not only_with_nulls:
        return per_key
    per_key = per_key.checkpoint()
    row = per_key.agg(*[F.count(F.col(f"`{names[c]}`")).alias(c) for c in columns]).first()
    keep = [names[c] for c in columns if row[c] > 0]
    return per_key.select(key, *[F.col(f"`{n}`") for n in keep])


def ratio_of_totals(
    df: DataFrame,
    key: str,
    totals: Mapping[str, str],
    ratios: Mapping[str, tuple[str, str]],
    guarded: bool = True,
) -> DataFrame:
    """Sums per key, then ratios of the sums (``a / (1 + b)`` when guarded)."""
    out = df.groupBy(key).agg(*[aggfns.agg_sum(F.col(c)).alias(name) for name, c in totals.items()])
    for name, (a, b) in ratios.items():
        den = (F.lit(1.0) + F.col(b)) if guarded else F.col(b)
        out = out.withColumn(name, F.try_divide(F.col(a).cast("double"), den.cast("double")))
    return out


def latest_period(
    df: DataFrame,
    key: str,
    period: str,
    spec: Spec,
    tiebreak: Sequence[str] = (),
    prefix: str = "last_",
) -> DataFrame:
    """Aggregate per (key, period), then keep the newest period's values.

    The newest period is taken with ``max_by`` over a (period, tie-break)
    struct: a partial aggregate, no window and no sort of a whole group.
    Output: key, ``<prefix><period>`` and one column per spec entry.
    """
    lvl1 = aggregate(df, [key, period, *tiebreak], spec)
    cols = [c for c in lvl1.columns if c not in (key, period, *tiebreak)]
    order = F.struct(F.col(period), *[F.col(t) for t in tiebreak])
    exprs = [F.max(F.col(period)).alias(f"{prefix}{period}")]
    for c in cols:
        exprs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"{prefix}{c}"))
    return lvl1.groupBy(key).agg(*exprs)


def flag_stats(df: DataFrame, key: str, pattern: str = "flag", fns: Sequence[str] = ("mean", "sum", "count"), prefix: str = "") -> DataFrame:
    """mean/sum/count of every column whose name contains ``pattern``."""
    flags = [c for c in df.columns if pattern in c and c != key]
    return aggregate(df, key, {c: list(fns) for c in flags}, prefix=prefix)


def global_stats(df: DataFrame, columns: Sequence[str], fns: Sequence[str] = ("min", "max", "median", "mean")) -> DataFrame:
    """One-row statistics of whole columns (plus ``nulls`` and ``nunique``).

    The whole table is one group here, so ``median`` uses the distributed exact
    quantiles (range-partitioned ranks) instead of one percentile buffer.
    """
    exprs, medians = [], []
    for c in columns:
        for fn in fns:
            if fn == "nulls":
                exprs.append(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))
            elif fn == "median":
                medians.append(c)
            else:
                name, build = aggfns.resolve(fn)
                exprs.append(build(F.col(c), None).alias(f"{c}_{name}"))
    order = [f"{c}_{fn}" for c in columns for fn in fns]
    out = df.agg(*exprs) if exprs else None
    if medians:
        from loomfeat.operators.joins import attach_one_row
        from loomfeat.operators.quantiles import exact_quantiles

        q = exact_quantiles(df, [], [(c, F.col(c), None) for c in medians], [0.5])
        q = q.select(*[F.col(f"{c}__q0").alias(f"{c}_median") for c in medians])
        out = q if out is None else attach_one_row(out, q)
    return out.select(*order)


@dataclass
class Block:
    """A named feature block: a frame keyed by ``key`` plus the key spine it belongs to."""

    name: str
    frame: DataFrame
    key: str
    notes: list[str] = field(default_factory=list)
