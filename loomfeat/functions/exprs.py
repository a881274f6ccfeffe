"""Row-level Column builders.

All builders return JVM-side expressions; nothing here runs Python per row.
Missing values are SQL NULL throughout: NaN never enters (rule N8), a division
by zero gives NULL instead of +-inf (rule N1).
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- sentinels


def null_if_equal(c: ColumnOrName, sentinel) -> Column:
    """``replace(sentinel, NaN)`` -> NULL where the value equals the sentinel."""
    return F.nullif(col(c), F.lit(sentinel))


def null_if(c: ColumnOrName, predicate: Column) -> Column:
    """Value becomes NULL where ``predicate`` holds (``x < -40000``, ``x < 0``)."""
    return F.when(~predicate | predicate.isNull(), col(c))


def nan_to_null(c: ColumnOrName) -> Column:
    """Ingest guard (N8): floating NaN becomes NULL."""
    x = col(c)
    return F.when(~F.isnan(x), x)


def fill_from(c: ColumnOrName, other: ColumnOrName) -> Column:
    """P5: fill missing values from another column."""
    return F.coalesce(col(c), col(other))


def fill_value(c: ColumnOrName, value) -> Column:
    """Fill missing values with a constant."""
    return F.coalesce(col(c), F.lit(value))


# ---------------------------------------------------------------- arithmetic


def ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b``; zero denominator -> NULL (documented divergence from +-inf)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def guarded_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """P10: ``a / (1 + b)``."""
    return F.try_divide(col(a).cast("double"), F.lit(1.0) + col(b).cast("double"))


def diff(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a - b``."""
    return col(a) - col(b)


def complement_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``1 - a / b``."""
    return F.lit(1.0) - ratio(a, b)


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """``sum(w_i * c_i)``; NULL-propagating like the reference."""
    return reduce(add, [col(c) * F.lit(float(w)) for c, w in weights.items()])


def product(cols: Iterable[ColumnOrName]) -> Column:
    """NULL-propagating product of columns."""
    return reduce(lambda x, y: x * y, [col(c) for c in cols])


def _compact(cols: Iterable[ColumnOrName]) -> Column:
    return F.array_compact(F.array(*[col(c).cast("double") for c in cols]))


def row_min(cols: Iterable[ColumnOrName]) -> Column:
    """Row-wise minimum skipping NULL."""
    return F.least(*[col(c) for c in cols])


def row_max(cols: Iterable[ColumnOrName]) -> Column:
    """Row-wise maximum skipping NULL."""
    return F.greatest(*[col(c) for c in cols])


def row_sum(cols: Iterable[ColumnOrName]) -> Column:
    """Row-wise sum skipping NULL; all missing -> 0."""
    return reduce(add, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_count(cols: Iterable[ColumnOrName]) -> Column:
    """Number of non-NULL values in a row."""
    return reduce(add, [col(c).isNotNull().cast("int") for c in cols])


def row_null_count(cols: Iterable[ColumnOrName]) -> Column:
    """Number of NULL values in a row."""
    return reduce(add, [col(c).isNull().cast("int") for c in cols])


def row_mean(cols: Iterable[ColumnOrName]) -> Column:
    """Row-wise mean over non-NULL values; none -> NULL."""
    cols = list(cols)
    return F.try_divide(row_sum(cols), row_count(cols).cast("double"))


def row_median(cols: Iterable[ColumnOrName]) -> Column:
    """Row-wise median over non-NULL values; none -> NULL."""
    s = F.array_sort(_compact(cols))
    n = F.size(s)
    lo = F.element_at(s, F.floor((n + 1) / 2).cast("int"))
    hi = F.element_at(s, F.floor(n / 2).cast("int") + 1)
    return F.when(n > 0, (lo + hi) / 2.0)


def row_std(cols: Iterable[ColumnOrName]) -> Column:
    """Row-wise sample standard deviation (ddof=1) over non-NULL values."""
    arr = _compact(cols)
    n = F.size(arr).cast("double")
    mean = F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v) / n
    ss = F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean))
    return F.when(n > 1, F.sqrt(ss / (n - 1.0)))


def row_spread(cols: Iterable[ColumnOrName]) -> Column:
    """Row-wise max - min (the row-wise intent of Q1)."""
    cols = list(cols)
    return row_max(cols) - row_min(cols)


# ---------------------------------------------------------------- flags


def flag(predicate: Column) -> Column:
    """1 where the predicate holds, else 0 (NULL -> 0, rule N5)."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def flag_gt(c: ColumnOrName, threshold) -> Column:
    """``1 if x > c else 0``."""
    return flag(col(c) > F.lit(threshold))


def flag_eq(c: ColumnOrName, value) -> Column:
    """``1 if x == v else 0``."""
    return flag(col(c) == F.lit(value))


def flag_in(c: ColumnOrName, values: Iterable) -> Column:
    """``1 if x in values else 0``."""
    return flag(col(c).isin(list(values)))


def flag_cmp(a: ColumnOrName, b: ColumnOrName) -> Column:
    """P20: ``1 if a > b else 0``."""
    return flag(col(a) > col(b))


def clamp_zero(c: ColumnOrName) -> Column:
    """``x if x > 0 else 0`` (missing -> 0)."""
    x = col(c)
    return F.when(x > 0, x).otherwise(F.lit(0))


def horizontal_sum(cols: Iterable[ColumnOrName]) -> Column:
    """Plain ``c1 + c2 + ...`` (NULL-propagating, like pandas on ints)."""
    return reduce(add, [col(c) for c in cols])


def value_map(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup as a CASE chain; unmapped -> ``default`` (NULL)."""
    x = col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(x == F.lit(k), F.lit(v))) if out is None else out.when(x == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def days_offset(ts: ColumnOrName, reference_date: str) -> Column:
    """Integer day offset of a date/timestamp against a reference date (<= 0 in the past)."""
    return F.datediff(F.to_date(col(ts)), F.to_date(F.lit(reference_date)))
