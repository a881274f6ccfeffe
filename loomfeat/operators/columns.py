"""Column selection, typing and missing-value fills.

Decisions that depend on data (type narrowing, type split, 0/1 detection,
global median/mean) take one global aggregate pass: a single row of
statistics reaches the driver, never data rows.
"""

from __future__ import annotations

import re
from typing import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


# ---------------------------------------------------------------- selection


def by_pattern(df: DataFrame, *substrings: str, exclude: Iterable[str] = ()) -> list[str]:
    """Columns whose name contains any of ``substrings``."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex and any(s in c for s in substrings)]


def by_regex(df: DataFrame, pattern: str, exclude: Iterable[str] = ()) -> list[str]:
    """Columns whose name matches a regular expression."""
    ex, rx = set(exclude), re.compile(pattern)
    return [c for c in df.columns if c not in ex and rx.search(c)]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """The categorical (string-typed) columns."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in ex]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def drop_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop a fixed list, ignoring names that are not present."""
    present = set(df.columns)
    return df.drop(*[c for c in columns if c in present])


def rename_all(df: DataFrame, fn) -> DataFrame:
    """Rename every column through one naming function."""
    return df.select(*[F.col(f"`{c}`").alias(fn(c)) for c in df.columns])


def cast_columns(df: DataFrame, columns: Iterable[str], to: str = "double") -> DataFrame:
    """Cast a set of columns (e.g. to double before aggregation)."""
    cs = set(columns)
    return df.select(*[(F.col(c).cast(to) if c in cs else F.col(c)).alias(c) for c in df.columns])


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant tag column (``is_train`` = 1 / 0 / -1)."""
    return df.withColumn(name, F.lit(value))


def key_spine(df: DataFrame, key: str) -> DataFrame:
    """The distinct keys of a table."""
    return df.select(key).distinct()


# ---------------------------------------------------------------- fills


def fill_zero(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``fillna(0)`` on a finished feature block."""
    return df.na.fill(0, subset=list(subset) if subset else None)


def fill_zero_before(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fill 0 on the raw rows before aggregating (changes mean/std)."""
    cs = set(columns)
    return df.select(*[(F.coalesce(F.col(c), F.lit(0)) if c in cs else F.col(c)).alias(c) for c in df.columns])


def _fill_with_stat(df: DataFrame, columns: Sequence[str], stat) -> DataFrame:
    stats = df.agg(*[stat(F.col(c)).alias(c) for c in columns])
    # one row of statistics, attached by a broadcast cross join (size 1 by construction)
    from loomfeat.operators.joins import attach_one_row

    out = attach_one_row(df, stats.select(*[F.col(c).alias(f"__fill_{c}") for c in columns]))
    return out.select(*[(F.coalesce(F.col(c), F.col(f"__fill_{c}")) if c in columns else F.col(c)).alias(c) for c in df.columns])


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with the global exact median of each column (distributed ranks, no one-task buffer)."""
    from loomfeat.operators.joins import attach_one_row
    from loomfeat.operators.quantiles import exact_quantiles

    columns = list(columns)
    q = exact_quantiles(df, [], [(c, F.col(c), None) for c in columns], [0.5])
    out = attach_one_row(df, q.select(*[F.col(f"{c}__q0").alias(f"__fill_{c}") for c in columns]))
    return out.select(*[(F.coalesce(F.col(c), F.col(f"__fill_{c}")) if c in columns else F.col(c)).alias(c) for c in df.columns])


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with the global mean of each column."""
    return _fill_with_stat(df, list(columns), F.avg)


# ---------------------------------------------------------------- data-driven typing

_INT_TYPES = [("tinyint", 127), ("smallint", 32767), ("int", 2147483647), ("bigint", None)]
_FLOAT32_MAX = 3.4028234663852886e38


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, tuple]:
    """(values, least, greatest) of each column in one pass; the last two are None without a value and for columns that are not numeric.

    Tasks fold Arrow batches column by column: an aggregate of thousands of buffers is too
    wide to be compiled and costs every value the interpretation of each of them. As in
    Spark, NaN is a value, and the greatest one.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns = list(columns) if columns is not None else list(df.columns)
    if not columns:
        return {}
    whole = {"byte", "short", "integer", "long"}
    kind = [("w" if kinds[c].typeName() in whole else "d") if isinstance(kinds[c], NumericType) else "n" for c in columns]
    reads = []
    for i, c in enumerate(columns):
        q = "`" + c.replace("`", "``") + "`"
        reads.append(f"{f'CAST({q} AS DOUBLE)' if kinds[c].typeName() == 'decimal' else q if kind[i] != 'n' else f'CASE WHEN {q} IS NOT NULL THEN true END'} AS c{i}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list = [(0, None, None)] * len(kind)
        for batch in batches:
            for i, column in enumerate(batch.columns):
                values = column.drop_null() if column.null_count else column
                if len(values):
                    n, low, high = found[i]
                    if kind[i] != "n":
                        v = values.to_numpy(zero_copy_only=False)
                        low = np.fmin.reduce(v if low is None else np.append(v, low))
                        high = np.max(v if high is None else np.append(v, high))
                    found[i] = n + len(values), low, high
        ends = [[None if x is None or kind[i] != own else x.item() for i, x in enumerate(e)] for own in "wd" for e in ([f[1] for f in found], [f[2] for f in found])]
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(kind)), pa.int32()), pa.array([f[0] for f in found], pa.int64()), *[pa.array(e, t) for e, t in zip(ends, types)]], names=["i", "n", "wl", "wh", "dl", "dh"])

    parts = df.selectExpr(*reads).mapInArrow(run, "i int, n long, wl long, wh long, dl double, dh double")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), *[F.expr(f"{'min' if e[1] == 'l' else 'max'}({e}) AS {e}") for e in ("wl", "wh", "dl", "dh")]).collect()
    out = {c: (0, None, None) for c in columns}
    for r in rows:
        own = kind[r.i]
        out[columns[r.i]] = (r.n, None, None) if own == "n" else (r.n, r[f"{own}l"], r[f"{own}h"])
    return out


def _narrowed(df: DataFrame, nums, ranges: dict[str, tuple]) -> DataFrame:
    target = {}
    for f in nums:
        _, lo, hi = ranges[f.name]
        if lo is None:
            continue
        if f.dataType.typeName() in ("byte", "short", "integer", "long"):
            for t, lim in _INT_TYPES:
                if lim is None or (lo > -lim - 1 and hi < lim):
                    target[f.name] = t
                    break
        else:
            target[f.name] = "float" if (lo > -_FLOAT32_MAX and hi < _FLOAT32_MAX) else "double"
    names = {c: "`" + c.replace("`", "``") + "`" for c in df.columns}
    # as text: one call to the JVM for hundreds of columns
    return df.selectExpr(*[f"CAST({q} AS {target[c]}) AS {q}" if c in target else q for c, q in names.items()])


def _narrowable(df: DataFrame, exclude: Iterable[str]) -> list:
    ex = set(exclude)
    return [f for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def narrow_types(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Range-based narrowing with strict bounds, from one min/max pass.

    Integers go to the smallest of tinyint/smallint/int/bigint whose open range
    holds (min, max); floating columns become float when within float32 range,
    else stay double (Spark has no float16, see Q13).
    """
    nums = _narrowable(df, exclude)
    return _narrowed(df, nums, value_ranges(df, [f.name for f in nums])) if nums else df


def write_narrowed(df: DataFrame, name: str, exclude: Iterable[str] = ()) -> DataFrame:
    """P31 of ``df`` written below the shared folder: one pass over the written columns gives the ranges."""
    return write_narrowed_counted(df, name, exclude)[0]


def write_narrowed_counted(df: DataFrame, name: str, exclude: Iterable[str] = ()) -> tuple[DataFrame, dict[str, int]]:
    """``write_narrowed``, and the number of values of each column, from the same pass."""
    from loomfeat.session import written

    out = written(df, name)
    ranges = value_ranges(out)
    return _narrowed(out, _narrowable(out, exclude), ranges), {c: r[0] for c, r in ranges.items()}


def few_distinct(df: DataFrame, columns: Sequence[str], limit: int) -> dict[str, int | None]:
    """Number of distinct values of each column, None from ``limit`` on; one pass, exact.

    Every task keeps the distinct values of a column until it has seen ``limit`` of them,
    and then only the fact: at most that many values per column leave a task.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    # equal values have one text: -0.0 is written as 0.0, and a float as its double
    texts = [(F.col(f"`{c}`").cast("double") + F.lit(0.0) if kinds[c].typeName() in ("float", "double") else F.col(f"`{c}`")).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[set | None] = [set() for _ in columns]
        for batch in batches:
            for i, own in enumerate(seen):
                if own is not None:
                    own.update(v for v in pc.unique(batch.column(i)).to_pylist() if v is not None)
                    if len(own) >= limit:
                        seen[i] = None
        rows = [(i, None) if own is None else (i, v) for i, own in enumerate(seen) for v in (own if own is not None else [None])]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.string())], names=["i", "v"])

    parts = df.select(*texts).mapInArrow(run, "i int, v string").distinct()
    counts = parts.groupBy("i").agg(F.count("v").alias("n"), F.max(F.col("v").isNull()).alias("full")).collect()
    found = {columns[r.i]: None if r.full or r.n >= limit else r.n for r in counts}
    return {c: found.get(c, 0) for c in columns}


def type_split(df: DataFrame, special: Iterable[str] = (), max_discrete: int = 25) -> tuple[list[str], list[str], list[str]]:
    """(string columns, numeric with < 25 distinct values or special, other numeric), exactly, in one pass."""
    special = set(special)
    cats = string_columns(df)
    nums = [c for c in df.columns if c not in cats]
    if not nums:
        return cats, [], []
    n = few_distinct(df, nums, max_discrete)
    disc = [c for c in nums if n[c] is not None or c in special]
    return cats, disc, [c for c in nums if c not in disc]


def binary_columns(df: DataFrame, exclude: Iterable[str] = (), skip_substring: str = "_MEAN") -> list[str]:
    """Columns with min == 0 and max == 1 whose name does not contain ``skip_substring``."""
    ex = set(exclude)
    cands = [c for c in numeric_columns(df) if c not in ex and skip_substring not in c]
    if not cands:
        return []
    row = df.agg(*[x for c in cands for x in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))]).first()
    return [c for c in cands if row[f"{c}__min"] == 0 and row[f"{c}__max"] == 1]
