"""Feature selection.

F1 (correlation pruning) needs every pairwise Pearson correlation of the
numeric columns, pairwise-complete (a pair uses the rows where both values are
present). The columns are cut into blocks; for each pair of blocks every task
folds its rows into centred co-moments (count, two means, two sums of squares,
one of products) of that pair of blocks, as matrix products of Arrow batches.
The rows (column i, block J) of those matrices are shuffled, merged in two
levels (buckets of tasks, then all) by the update formula of centred moments,
and become correlations on Spark. A task holds the moments of one pair of
blocks, and the driver gets one maximum per column, whatever their number.

The decision rule is the reference's: drop column j when any *earlier* column
i (kept or not) has |r_ij| > threshold; protected columns are never dropped
but do take part as i. A zero variance or a single shared row gives no
correlation (never dropped).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeat.operators.columns import numeric_columns

#: Columns of a block: a task holds six matrices of BLOCK x BLOCK doubles (12 MB).
BLOCK = 512
#: Tasks whose moments are merged first.
TASKS = 64
#: A sum of squares below this share of count * mean^2 is rounding, not variance.
ROUNDING = 1e-13


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def _locations(df: DataFrame) -> dict[int, tuple[float, float]]:
    """(mean, largest absolute value) of each column by its place; without any value (0, 1)."""
    p = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, top = np.zeros(p, np.int64), np.zeros(p), np.zeros(p)
        for batch in batches:
            x = _matrix(batch)
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            n, total, top = n + there.sum(0), total + x.sum(0), np.maximum(top, np.abs(x).max(0, initial=0.0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p)), pa.array(n), pa.array(total), pa.array(top)], names=["i", "n", "total", "top"])

    rows = df.mapInArrow(run, "i long, n long, total double, top double").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("top").alias("top")).collect()
    return {r.i: (r.total / r.n if r.n else 0.0, r.top or 1.0) for r in rows}


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Centred moments (n, mean x, mean y, Sxx, Syy, Sxy along the first axis) of two parts together."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    weight = a[0] * share
    return np.stack([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight])


def _against_present(a: np.ndarray, present: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``a.T @ present``, where ``whole`` marks the columns of ``present`` that are all ones: these take plain sums."""
    out = np.empty((a.shape[1], present.shape[1]))
    out[:, whole] = a.sum(0)[:, None]
    if not whole.all():
        out[:, ~whole] = a.T @ present[:, ~whole]
    return out


def _batch_moments(x: np.ndarray, y: np.ndarray | None = None) -> np.ndarray:
    """Centred moments of every column of ``x`` with every one of ``y`` (None: of ``x``).

    Only the products of values need all pairs of columns; sums against a column without a
    missing value are sums of the other column.
    """
    mx = ~np.isnan(x)
    x, wx, mx = np.where(mx, x, 0.0), mx.all(0), mx.astype(float)
    if y is None:
        n, sx, sxx = _against_present(mx, mx, wx), _against_present(x, mx, wx), _against_present(x * x, mx, wx)
        y, sy, syy = x, sx.T, sxx.T
    else:
        my = ~np.isnan(y)
        y, wy, my = np.where(my, y, 0.0), my.all(0), my.astype(float)
        n, sx, sxx = _against_present(mx, my, wy), _against_present(x, my, wy), _against_present(x * x, my, wy)
        sy, syy = _against_present(y, mx, wx).T, _against_present(y * y, mx, wx).T
    ax, ay = (np.divide(s, n, out=np.zeros_like(n), where=n > 0) for s in (sx, sy))
    return np.stack([n, ax, ay, sxx - sx * ax, syy - sy * ay, x.T @ y - sx * ay])


def correlation_table(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(i, j, r): |Pearson r| of every pair of ``columns`` by their places, i < j; null where there is none."""
    columns = list(columns)
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    at = _locations(wide)
    starts = range(0, len(columns), block)
    parts = [_pair_of_blocks(wide, at, range(a, min(a + block, len(columns))), range(b, min(b + block, len(columns)))) for a in starts for b in starts if a <= b]
    rows = reduce(DataFrame.unionAll, parts)
    schema = "i long, first long, moments binary"

    def merge(t: pa.Table) -> pa.Table:
        whole = reduce(_merged, (np.frombuffer(m, np.float64).reshape(6, -1) for m in t["moments"].to_pylist()))
        return pa.table({"i": t["i"][:1], "first": t["first"][:1], "moments": pa.array([whole.tobytes()], pa.binary())})

    def correlate(t: pa.Table) -> pa.Table:
        i, first = t["i"][0].as_py(), t["first"][0].as_py()
        n, mx, my, sxx, syy, sxy = np.frombuffer(merge(t)["moments"][0].as_py(), np.float64).reshape(6, -1)
        live = (sxx > ROUNDING * n * mx * mx) & (syy > ROUNDING * n * my * my) & (sxx > 0) & (syy > 0)
        r = np.abs(np.divide(sxy, np.sqrt(np.maximum(sxx, 0)) * np.sqrt(np.maximum(syy, 0)), out=np.zeros_like(sxy), where=live))
        j = first + np.arange(len(r))
        later = j > i
        return pa.table({"i": pa.array(np.full(later.sum(), i)), "j": pa.array(j[later]), "r": pa.array(r[later], mask=~live[later] | np.isnan(r[later]))})

    merged = rows.groupBy("i", "first", F.expr(f"task div {TASKS}").alias("bucket")).applyInArrow(merge, schema)
    return merged.groupBy("i", "first").applyInArrow(correlate, "i long, j long, r double")


def _pair_of_blocks(wide: DataFrame, at: dict[int, tuple[float, float]], xs: range, ys: range) -> DataFrame:
    """(task, i, first, moments): centred moments of column i with the columns from ``first`` on, per task."""
    used = sorted({*xs, *ys})
    mean, top = (np.array([at.get(k, (0.0, 1.0))[n] for k in used]) for n in (0, 1))
    px, py = [used.index(k) for k in xs], [used.index(k) for k in ys]
    first = ys[0]
    places = list(xs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            if batch.num_rows:
                x = (_matrix(batch) - mean) / top  # near zero, and squares neither overflow nor vanish
                m = _batch_moments(x[:, px], None if px == py else x[:, py])
                whole = m if whole is None else _merged(whole, m)
        if whole is not None:
            rows = [np.ascontiguousarray(whole[:, k]).tobytes() for k in range(len(places))]
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array([first] * len(rows)), pa.array(rows, pa.binary())], names=["i", "first", "moments"])

    part = wide.select(*[f"c{k}" for k in used]).mapInArrow(run, "i long, first long, moments binary")
    return part.withColumn("task", F.spark_partition_id())


def greatest_correlations(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> list[float | None]:
    """For each of ``columns``, the largest |r| with an earlier one (None: there is none)."""
    best = correlation_table(df, columns, block).groupBy("j").agg(F.max("r").alias("r")).collect()
    found = {r.j: r.r for r in best}
    return [found.get(k) for k in range(len(columns))]


def correlation_prune(
    df: DataFrame,
    threshold: float = 0.9,
    protect: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    block: int = BLOCK,
) -> tuple[DataFrame, list[str]]:
    """drop columns highly correlated with an earlier column. Returns (frame, dropped)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    if len(cols) < 2:
        return df, []
    best = greatest_correlations(df, cols, block)
    drop = [c for c, r in zip(cols, best) if r is not None and r > threshold and c not in set(protect)]
    return df.drop(*drop), drop


def ranked_prune(df: DataFrame, ranked: Sequence[str], keep_fraction: float, always_keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """drop the last ``int(n * (1 - keep_fraction))`` names of a ranked list (best first)."""
    from loomfeat.operators.setops import bottom_fraction

    tail = [c for c in bottom_fraction(list(ranked), keep_fraction) if c not in set(always_keep)]
    present = [c for c in tail if c in set(df.columns)]
    return df.drop(*present), present


def accumulate_importance(fold_importances: DataFrame, n_folds: int, feature: str = "feature", importance: str = "importance") -> DataFrame:
    """sum of per-fold importances divided by the number of folds (Q8: by k)."""
    return fold_importances.groupBy(feature).agg((F.sum(importance) / F.lit(float(n_folds))).alias(importance))
