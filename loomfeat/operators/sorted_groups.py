"""Statistics of groups that one task may hold, many at once, in one pass of Arrow batches.

A grouped aggregate of hundreds of statistics is slow in Spark: the generated code is too
large to be compiled, so every row costs every statistic's interpretation, and each partial
group ships all of its buffers. Here the rows move once, as they are (each column once, each
slice as a flag), to the task of their key and are sorted by it; a batch sorts each column
within its groups, and every statistic of a slice is then a sum or a place in that order.
A task holds a batch and a group. Groups above ``GROUP_ROWS`` rows are the caller's to take
another way; ``large_groups`` finds them by one count of the keys.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of the largest group that one task sorts.
GROUP_ROWS = 1 << 15

#: Statistics of ``statistics``, besides quantiles; ``size`` is the rows of the slice.
FUNCTIONS = {"min", "max", "mean", "sum", "std", "var", "median", "count", "size", "nunique", "nonzero", "skew", "kurt", "iqr"}
_WHOLE = {"count", "size", "nunique"}
_RANKS = {"median": (0.5,), "iqr": (0.25, 0.75)}


def large_groups(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame | None:
    """The keys, written, that more than ``group_rows`` rows have; None if there is none."""
    from loomfeat.session import written

    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > group_rows).select(*keys)
    return None if large.isEmpty() else written(large, "large-groups")


class _Ranked:
    """The values of one column in one slice: sorted within the groups, with their sums."""

    def __init__(self, x: np.ndarray, group: np.ndarray, total: int):
        self.x, self.group = x, group
        self.n = np.bincount(group, minlength=total)
        self.some = self.n > 0
        self.first = (np.cumsum(self.n) - self.n)[self.some]
        self.last = self.first + self.n[self.some] - 1
        self.done: dict[object, np.ndarray] = {}

    def _spread(self, some: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.n))
        out[self.some] = some
        return out

    def of(self, what: object) -> np.ndarray:
        if what not in self.done:
            self.done[what] = self._compute(what)
        return self.done[what]

    def _compute(self, what: object) -> np.ndarray:
        if not len(self.x):
            return np.zeros(len(self.n))
        if what == "min":
            return self._spread(self.x[self.first])
        if what == "max":
            return self._spread(self.x[self.last])
        if what == "sum":
            return self._spread(np.add.reduceat(self.x, self.first))
        if what == "mean":
            return np.divide(self.of("sum"), self.n, out=np.zeros(len(self.n)), where=self.some)
        if what == "nunique":
            new = np.ones(len(self.x))
            new[1:] = self.x[1:] != self.x[:-1]
            new[self.first] = 1
            return self._spread(np.add.reduceat(new, self.first))
        if what == "zeros":
            return self._spread(np.add.reduceat((self.x == 0).astype(float), self.first))
        if isinstance(what, tuple):  # a sum of powers of the distances from the mean; equal values have none
            d = self.x - self.of("mean")[self.group]
            return np.where(self.of("min") == self.of("max"), 0.0, self._spread(np.add.reduceat(d ** what[1], self.first)))
        pos = what * (self.n[self.some] - 1)
        low, high = np.floor(pos).astype(np.int64), np.ceil(pos).astype(np.int64)
        a, b = self.x[self.first + low], self.x[self.first + high]
        return self._spread(np.where(low == high, a, (high - pos) * a + (pos - low) * b))


def _value(r: _Ranked, rows: np.ndarray, sliced: bool, fn: object) -> tuple[np.ndarray, np.ndarray]:
    """(values, where there is none) of a statistic for each group, by the rules of ``aggfns``."""
    n, none = r.n, ~r.some
    if fn in ("count", "size", "sum", "nunique"):
        return {"count": lambda: n, "size": lambda: rows}.get(fn, lambda: r.of(fn))(), (rows == 0) if sliced else np.zeros(len(n), bool)
    if fn == "nonzero":
        return (rows - r.of("zeros")) / np.maximum(rows, 1), rows == 0
    if fn in ("std", "var"):
        var = r.of(("power", 2)) / np.maximum(n - 1, 1)
        return np.sqrt(var) if fn == "std" else var, n < 2
    if fn == "median":
        return r.of(0.5), none
    if fn == "iqr":
        return r.of(0.75) - r.of(0.25), none | (n < rows)
    if fn in ("skew", "kurt"):
        m2 = r.of(("power", 2))
        flat = ~(m2 > 0)
        safe = np.where(flat, 1.0, m2)
        value = np.sqrt(n) * r.of(("power", 3)) / safe**1.5 if fn == "skew" else n * r.of(("power", 4)) / (safe * safe) - 3.0
        return value, none | (n < rows) | flat
    return r.of(fn), none


def statistics(df: DataFrame, keys: Sequence[str], items: Sequence[tuple[str, Column, Column | None, object]], valued: bool = False) -> DataFrame:
    """One row per group: keys and, for each (name, value, where, function), a column.

    ``value`` must be numeric and is taken as a double; a function is a name of ``FUNCTIONS``
    or a share (a quantile). ``where`` is a slice of the rows. Rows with a NULL key are a
    group. Counts are long, all else double. ``valued`` leaves out groups without any value.
    """
    keys = list(keys)
    values: dict[object, tuple[int, Column]] = {}  # a column or a slice of several items is moved once
    flags: dict[int, tuple[int, Column]] = {}
    plain = {str(F.col(c)): c for c in df.columns}
    plan: dict[tuple[int, int | None], list] = {}  # (value, flag) -> (place, function)
    for place, (_, value, where, fn) in enumerate(items):
        own = plain.get(str(value)) or id(value)
        if own not in values:
            values[own] = (len(values), value.cast("double"))
        if where is not None and id(where) not in flags:
            flags[id(where)] = (len(flags), F.coalesce(where, F.lit(False)))
        plan.setdefault((values[own][0], None if where is None else flags[id(where)][0]), []).append((place, fn))
    at = [F.col(f"`{k}`") for k in keys]
    rows = df.select(*at, *[v.alias(f"__v{i}") for i, v in values.values()], *[f.alias(f"__f{i}") for i, f in flags.values()])
    n_keys, n_values = len(keys), len(values)
    whole = [fn in _WHOLE for *_, fn in items]
    names = [*keys, *[name for name, *_ in items]]
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys] + [T.StructField(name, T.LongType() if w else T.DoubleType()) for (name, *_), w in zip(items, whole)]

    def of_groups(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        total = len(starts)
        group = np.repeat(np.arange(total), np.diff([*starts, batch.num_rows]))
        ordered = []
        for i in range(n_values):
            column = batch.column(n_keys + i)
            there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            v = column.to_numpy(zero_copy_only=False)[there] + 0.0  # -0.0 is 0.0
            order = np.lexsort((v, group[there]))
            ordered.append((v[order], there[order]))
        marks = [batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in range(n_keys + n_values, batch.num_columns)]
        sizes = {None: np.bincount(group, minlength=total), **{f: np.bincount(group[m], minlength=total) for f, m in enumerate(marks)}}
        out: list = [None] * len(whole)
        seen = np.zeros(total, bool)
        with np.errstate(all="ignore"):  # infinite values
            for (v, f), wanted in plan.items():
                x, o = ordered[v]
                if f is not None:
                    inside = marks[f][o]
                    x, o = x[inside], o[inside]
                r = _Ranked(x, group[o], total)
                seen |= r.some
                for place, fn in wanted:
                    value, none = _value(r, sizes[f], f is not None, fn)
                    out[place] = pa.array(np.rint(value).astype(np.int64) if whole[place] else value.astype(np.float64), mask=none)
        head = [batch.column(k).take(pa.array(starts)) for k in range(n_keys)]
        result = pa.RecordBatch.from_arrays([*head, *out], names=names)
        return result.filter(pa.array(seen)) if valued else result

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of a group that may go on
        for batch in batches:
            if batch.num_rows:
                both = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
                starts = _group_starts(both, n_keys)
                last = int(starts[-1])
                if last:
                    yield of_groups(both.slice(0, last), starts[:-1])
                held = [both.slice(last)]
        if held:
            yield of_groups(held[0], np.zeros(1, np.int64))

    return rows.repartition(*at).sortWithinPartitions(*at).mapInArrow(run, T.StructType(fields))


def _group_starts(batch: pa.RecordBatch, n_keys: int) -> np.ndarray:
    """The rows whose key, the first ``n_keys`` columns, is not that of the row before."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for k in range(n_keys):
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)
