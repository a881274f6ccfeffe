"""Aggregate-function builders with the reference's null rules.

Every builder takes the value column ``x`` and an optional slice predicate
``where``. Rows outside the slice are turned into NULL (``when(where, x)``),
which is exactly ``agg(x) FILTER (WHERE where)`` for NULL-skipping aggregates,
so many slices fuse into a single ``groupBy().agg()`` (one shuffle).

Guards (rules of SURVEY section 1.1):

* N2  ``sum`` of a group that has rows in the slice but only NULL values is 0;
      a group with no row in the slice is NULL.
* N3  ``count``/``size`` of a group with no row in the slice is NULL, not 0.
* N6  non-zero rate counts NULL as non-zero.
* N9  ``skew``/``kurt``/``iqr`` are NULL once any value of the slice is NULL.
* N12 trend slope: NULL if any y is NULL, 0 for a single row.

All functions are built-in Catalyst aggregates, so they are partially
aggregated map-side (sum/count/avg/min/max/std/var/skew/kurt/slope are
algebraic; exact median/percentile keep a value->count map per group).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

AggBuilder = Callable[[Column, Column | None], Column]


def _in(x: Column, where: Column | None) -> Column:
    return x if where is None else F.when(where, x)


def slice_rows(where: Column | None) -> Column:
    """Number of rows of the group that fall in the slice."""
    return F.count(F.lit(1)) if where is None else F.count_if(F.coalesce(where, F.lit(False)))


def _guard(value: Column, where: Column | None) -> Column:
    """NULL for a group without any row in the slice."""
    return value if where is None else F.when(slice_rows(where) > 0, value)


def agg_min(x, where=None):
    return F.min(_in(x, where))


def agg_max(x, where=None):
    return F.max(_in(x, where))


def agg_mean(x, where=None):
    return F.avg(_in(x, where))


def agg_sum(x, where=None):
    return _guard(F.coalesce(F.sum(_in(x, where)), F.lit(0)), where)


def agg_std(x, where=None):
    return F.stddev_samp(_in(x, where))


def agg_var(x, where=None):
    return F.var_samp(_in(x, where))


QUARTILES = [0.25, 0.5, 0.75]


def _quartiles(x, where):
    """One exact percentile buffer per (column, slice) shared by median and iqr:
    Catalyst de-duplicates identical aggregate expressions of one Aggregate."""
    return F.percentile(_in(x, where), QUARTILES)


def agg_median(x, where=None):
    return _quartiles(x, where)[1]


def agg_count(x, where=None):
    return _guard(F.count(_in(x, where)), where)


def agg_size(x, where=None):
    return _guard(slice_rows(where), where)


def agg_nunique(x, where=None):
    return _guard(F.count_distinct(_in(x, where)), where)


def agg_nonzero_rate(x, where=None):
    """``(x != 0).mean()`` where a NULL counts as non-zero."""
    return F.avg(_in((~x.eqNullSafe(F.lit(0))).cast("int"), where))


def _complete(x: Column, where: Column | None) -> Column:
    """True when no value of the slice is NULL."""
    return F.count(_in(x, where)) == slice_rows(where)


def agg_skew(x, where=None):
    return F.when(_complete(x, where), F.skewness(_in(x, where)))


def agg_kurt(x, where=None):
    return F.when(_complete(x, where), F.kurtosis(_in(x, where)))


def agg_iqr(x, where=None):
    q = _quartiles(x, where)
    return F.when(_complete(x, where), q[2] - q[0])


def _power_sums(d: Column, where: Column | None):
    """Sums of d, d^2, d^3, d^4 over the slice (plain algebraic sums, shared between
    skew and kurt of one column and slice)."""
    v = _in(d.cast("double"), where)
    return F.count(v), F.sum(v), F.sum(v * v), F.sum(v * v * v), F.sum(v * v * v * v)


def _central(d: Column, where: Column | None):
    n, s1, s2, s3, s4 = _power_sums(d, where)
    n = n.cast("double")
    mean = s1 / n
    m2 = s2 - s1 * mean
    m3 = s3 - F.lit(3.0) * mean * s2 + F.lit(2.0) * n * mean * mean * mean
    m4 = s4 - F.lit(4.0) * mean * s3 + F.lit(6.0) * mean * mean * s2 - F.lit(3.0) * n * mean * mean * mean * mean
    return n, m2, m3, m4


def skew_from_shift(shift: Column) -> AggBuilder:
    """Population skewness from power sums of ``x - shift`` (``shift`` is a value of the
    group, e.g. its newest row, which keeps the sums well conditioned). Constant -> NULL."""

    def build(x, where=None):
        n, m2, m3, _ = _central(x - shift, where)
        ok = _complete(x, where) & (m2 > 0) & (F.min(_in(x, where)) < F.max(_in(x, where)))
        return F.when(ok, F.sqrt(n) * m3 / F.pow(m2, 1.5))

    return build


def kurt_from_shift(shift: Column) -> AggBuilder:
    """Population excess kurtosis from power sums of ``x - shift``. Constant -> NULL."""

    def build(x, where=None):
        n, m2, _, m4 = _central(x - shift, where)
        ok = _complete(x, where) & (m2 > 0) & (F.min(_in(x, where)) < F.max(_in(x, where)))
        return F.when(ok, n * m4 / (m2 * m2) - F.lit(3.0))

    return build


TEXT_FNS = {"min", "max", "mean", "sum", "std", "var", "median", "count", "size", "nonzero", "skew", "kurt", "iqr"}


def agg_text(fn: str, x: str, where_sql: str | None) -> Column:
    """The aggregate ``fn`` of column ``x`` over the slice ``where_sql`` as one SQL expression.

    Same semantics and result types as the Column builders above (FILTER is the
    slice), built with one JVM call; wide specs plan much faster this way.
    """
    x = f"`{x}`"
    f = f" FILTER (WHERE {where_sql})" if where_sql else ""
    rows = f"count(1){f}"

    def guard(e):
        return f"CASE WHEN {rows} > 0 THEN {e} END" if where_sql else e

    q = f"percentile({x}, array(0.25, 0.5, 0.75)){f}"
    complete = f"count({x}){f} = {rows}"
    text = {
        "min": f"min({x}){f}",
        "max": f"max({x}){f}",
        "mean": f"avg({x}){f}",
        "sum": guard(f"coalesce(sum({x}){f}, 0)"),
        "std": f"stddev_samp({x}){f}",
        "var": f"var_samp({x}){f}",
        "median": f"element_at({q}, 2)",
        "count": guard(f"count({x}){f}"),
        "size": guard(rows),
        "nonzero": f"avg(CAST(NOT ({x} <=> 0) AS INT)){f}",
        "skew": f"CASE WHEN {complete} THEN skewness({x}){f} END",
        "kurt": f"CASE WHEN {complete} THEN kurtosis({x}){f} END",
        "iqr": f"CASE WHEN {complete} THEN element_at({q}, 3) - element_at({q}, 1) END",
    }[fn]
    return F.expr(text)


def sql_literal(v) -> str:
    """A Spark SQL literal for a slice predicate."""
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def moment_sql(fn: str, x: str, shift: str, where_sql: str | None) -> Column:
    """Skew/kurt from power sums of ``x - shift`` as one SQL expression (column names and a
    predicate in SQL text): one JVM call instead of a tree of small ones. Same result as
    ``skew_from_shift``/``kurt_from_shift``; identical sums are shared by Catalyst."""
    x, shift = f"`{x}`", f"`{shift}`"
    inw = (lambda e: f"CASE WHEN {where_sql} THEN {e} END") if where_sql else (lambda e: e)
    d = inw(f"CAST({x} - {shift} AS DOUBLE)")
    n_rows = f"count_if(coalesce({where_sql}, false))" if where_sql else "count(1)"
    n, s1 = f"CAST(count({d}) AS DOUBLE)", f"sum({d})"
    s2, s3, s4 = f"sum({d} * {d})", f"sum({d} * {d} * {d})", f"sum({d} * {d} * {d} * {d})"
    mean = f"({s1} / {n})"
    m2 = f"({s2} - {s1} * {mean})"
    ok = f"count({inw(x)}) = {n_rows} AND {m2} > 0 AND min({inw(x)}) < max({inw(x)})"
    if fn == "skew":
        m3 = f"({s3} - 3.0 * {mean} * {s2} + 2.0 * {n} * {mean} * {mean} * {mean})"
        value = f"sqrt({n}) * {m3} / pow({m2}, 1.5)"
    else:
        m4 = f"({s4} - 4.0 * {mean} * {s3} + 6.0 * {mean} * {mean} * {s2} - 3.0 * {n} * {mean} * {mean} * {mean} * {mean})"
        value = f"{n} * {m4} / ({m2} * {m2}) - 3.0"
    return F.expr(f"CASE WHEN {ok} THEN {value} END")


def agg_share(value) -> AggBuilder:
    """Share of rows whose category equals ``value`` (mean of a one-hot column)."""

    def build(x, where=None):
        return F.avg(_in(x.eqNullSafe(F.lit(value)).cast("int"), where))

    return build


def agg_first_valid(order: Column) -> AggBuilder:
    """The non-NULL value with the greatest ``order`` (a struct for tie-breaks)."""

    def build(x, where=None):
        keep = x.isNotNull() if where is None else (x.isNotNull() & where)
        return F.max_by(x, F.when(keep, order))

    return build


def agg_trend(x_pos: Column) -> AggBuilder:
    """Least-squares slope of the value on ``x_pos``."""

    def build(y, where=None):
        n = slice_rows(where)
        ny = F.count(_in(y, where))
        slope = F.regr_slope(_in(y, where), _in(x_pos.cast("double"), where))
        return F.when(n == 0, F.lit(None)).when(ny < n, F.lit(None)).when(n == 1, F.lit(0.0)).otherwise(slope)

    return build


AGGREGATES: dict[str, AggBuilder] = {
    "min": agg_min,
    "max": agg_max,
    "mean": agg_mean,
    "sum": agg_sum,
    "std": agg_std,
    "var": agg_var,
    "median": agg_median,
    "count": agg_count,
    "size": agg_size,
    "nunique": agg_nunique,
    "nonzero": agg_nonzero_rate,
    "skew": agg_skew,
    "kurt": agg_kurt,
    "iqr": agg_iqr,
}


def resolve(fn) -> tuple[str, AggBuilder]:
    """A spec entry is a name from ``AGGREGATES`` or a ``(name, builder)`` pair."""
    if isinstance(fn, str):
        try:
            return fn, AGGREGATES[fn]
        except KeyError as exc:
            raise ValueError(f"unknown aggregate {fn!r}; known: {sorted(AGGREGATES)}") from exc
    name, builder = fn
    return name, builder
