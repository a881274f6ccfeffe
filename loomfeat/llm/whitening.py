"""Embedding whitening (operator 11): exact cross-products from bit planes, centred as integers.

Entries become integers, shifted by the least of all so that none is negative. Every task
packs the bit planes of its rows, dimension by dimension, into 64-bit words (one bit a row);
the cross-product of two dimensions is the sum over pairs of planes of the popcount of their
AND, weighted by the planes' power of two. Counts are whole numbers, so tasks may be summed
in any order and the result does not depend on how rows were dealt. The covariance is
centred as integers, n * C - S * S', and divided once, before the eigenvectors are taken.

Vectors of different lengths have fits of their own. What reaches the driver is one row per
pair of dimensions (of each length), whatever the number of vectors.

Rows whose vector is null or holds null or non-finite entries are left out; a null id stays.
Entries beyond 2^51 count as 2^51. A component without variance (constant or repeated
vectors, or one vector only) has a null ``whitened``. Empty vectors and tables give no rows.
Other columns of the table, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfeat.llm.common import col, materialise, small_batches

#: Rows whose planes are packed at a time (64 words a plane).
SLICE = 4096
#: A cross-product travels as four parts of 40 bits, whose sums over tasks fit a long.
LIMBS, LIMB = 4, 40
#: Entries are held within this bound, so that the shifted ones fit 63 bits.
LARGEST = float(1 << 61)


def whole_entries(vector: Column, scale: float = 1024.0, shift: int = 100_000) -> Column:
    """floor(scale * entry) + shift of every entry, taken as double; null where the vector takes no part."""
    d = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(d, lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(shift))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


class CrossProducts:
    """Sums and cross-products of rows of ``dim`` integers below 2^bits, by popcounts of bit planes."""

    def __init__(self, dim: int, bits: int):
        self.dim, self.bits, self.n = dim, bits, 0
        self.counts = np.zeros((2 * bits - 1, dim, dim), np.int64)  # by the power of two of a pair of planes
        self.ones = np.zeros((bits, dim), np.int64)

    def add(self, rows: np.ndarray) -> None:
        for start in range(0, len(rows), SLICE):
            self._add(rows[start : start + SLICE])

    def _add(self, rows: np.ndarray) -> None:
        words = -(-len(rows) // 64)
        padded = np.zeros((words * 64, self.dim), np.uint64)
        padded[: len(rows)] = rows
        planes = np.empty((self.bits, self.dim, words), np.uint64)
        for b in range(self.bits):
            packed = np.packbits((padded >> np.uint64(b)).astype(np.uint8) & 1, axis=0, bitorder="little")
            planes[b] = np.ascontiguousarray(packed.T).view(np.uint64)
        self.n += len(rows)
        self.ones += np.bitwise_count(planes).sum(-1, dtype=np.int64)
        for i in range(self.dim):
            for a in range(self.bits):
                both = np.bitwise_count(planes[a, i] & planes[:, i:])
                self.counts[a : a + self.bits, i, i:] += both.sum(-1, dtype=np.int64)

    def rows(self) -> pa.RecordBatch:
        """(dim, i, j, parts): cross-products for i <= j, sums at j = -1, the number of rows at i = j = -1."""
        i, j = np.triu_indices(self.dim)
        product = sum((c[i, j].astype(object) << p for p, c in enumerate(self.counts)), np.zeros(len(i), object))
        total = sum((c.astype(object) << b for b, c in enumerate(self.ones)), np.zeros(self.dim, object))
        value = np.concatenate([product, total, np.array([self.n], object)])
        at = np.concatenate([i, np.arange(self.dim), [-1]]), np.concatenate([j, np.full(self.dim + 1, -1)])
        mask = (1 << LIMB) - 1
        cols = [np.full(len(value), self.dim), *at, *[(value >> (LIMB * k)) & mask for k in range(LIMBS)]]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["dim", "i", "j", *[f"l{k}" for k in range(LIMBS)]])


def by_length(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) for each length of the integer lists of an Arrow batch; none is null."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat, starts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield int(dim), at, flat[starts[at][:, None] + np.arange(dim)]


@dataclass
class Fit:
    """Exact moments of the vectors of one length, and the axes of their covariance by falling eigenvalue."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray


def fit(entries: DataFrame) -> dict[int, Fit]:
    """A ``Fit`` for each length of the integer vectors in the only column of ``entries`` (none null)."""
    x = F.col(entries.columns[0])
    low, high = entries.select(F.array_min(x).alias("a"), F.array_max(x).alias("b")).agg(F.min("a"), F.max("b")).first()
    if low is None:
        return {}
    bits = max(1, (high - low).bit_length())
    small_batches(entries.sparkSession)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, CrossProducts] = {}
        for batch in batches:
            for dim, _, rows in by_length(batch.column(0)):
                if dim:
                    found.setdefault(dim, CrossProducts(dim, bits)).add((rows - low).astype(np.uint64))
        for products in found.values():
            yield products.rows()

    limbs = [f"l{k}" for k in range(LIMBS)]
    parts = entries.mapInArrow(scatter, "dim long, i long, j long, " + ", ".join(f"{c} long" for c in limbs))
    sums = parts.groupBy("dim", "i", "j").agg(*[F.sum(c).alias(c) for c in limbs]).collect()
    value = {(r.dim, r.i, r.j): sum(r[c] << (LIMB * k) for k, c in enumerate(limbs)) for r in sums}
    return {dim: _axes(dim, value, low) for dim in sorted({d for d, _, _ in value})}


def _axes(dim: int, value: dict[tuple[int, int, int], int], low: int) -> Fit:
    n = value[dim, -1, -1]
    s = [value[dim, i, -1] for i in range(dim)]
    cov = np.empty((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            cov[i, j] = cov[j, i] = (n * value[dim, i, j] - s[i] * s[j]) / (n * n)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(dim)] < 0, -1.0, 1.0)
    return Fit(n, [int(t + n * low) for t in s], cov, np.maximum(values, 0.0), axes)


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> tuple[DataFrame, dict[int, Fit]]:
    """(id, dim, deviation, w) of every vector that takes part, and the fits.

    ``deviation`` is the exact sum of (n * x - S)^2 (null beyond a long); ``w`` holds the
    whitened projections on the first ``components`` axes (all, if fewer).
    """
    x = table.select(col(id_col).alias("id"), whole_entries(col(vector_col)).alias("x")).where("size(x) > 0")
    fits = fit(x.select("x"))
    frame = {}
    for dim, f in fits.items():
        k = min(components, dim)
        live = f.values[:k] > f.values[0] * dim * np.finfo(float).eps
        root = np.sqrt(np.where(live, f.values[:k], 1.0))
        frame[dim] = (f.n, f.sums, f.axes[:, :k] / root, live)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, rows in by_length(batch.column(1)):
                n, sums, axes, live = frame[dim]
                away = rows.astype(object) * n - np.array(sums, object) if _wide(rows, n, sums) else rows * n - np.array(sums)
                exact = _squares(away)
                w = (away / n).astype(np.float64) @ axes
                w = pa.array(w.ravel(), mask=np.broadcast_to(~live, w.shape).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        pa.array(np.full(len(at), dim, np.int32)),
                        pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()),
                        pa.ListArray.from_arrays(np.arange(0, len(w) + 1, len(live), dtype=np.int32), w),
                    ],
                    names=["id", "dim", "deviation", "w"],
                )

    id_type = x.schema["id"].dataType.simpleString()
    return x.mapInArrow(project, f"id {id_type}, dim int, deviation long, w array<double>"), fits


def _wide(rows: np.ndarray, n: int, sums: list[int]) -> bool:
    """Whether n * x - S may leave 62 bits."""
    return n * max(abs(int(rows.max())), abs(int(rows.min()))) + max(map(abs, sums)) >= 1 << 62


def _squares(away: np.ndarray) -> list[int]:
    """Exact sums of squares of rows."""
    if away.dtype != object and int(np.abs(away).max()) ** 2 * away.shape[1] >= 1 << 62:
        away = away.astype(object)
    return [int(v) for v in (away * away).sum(1)]


def digests(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """One row per vector and component: n, exact deviation, whitened value, explained share, identity error.

    The identity error is measured on the whitened values themselves, over all vectors:
    the largest entry of their covariance minus the identity (one value for the table).
    """
    projected, fits = whiten(table, id_col, vector_col, components)
    projected = materialise(projected, "whitened")
    share = {d: f.values[:components] / t for d, f in fits.items() if (t := np.trace(f.covariance)) > 0}
    per_dim = F.create_map(*[F.lit(v) for d, s in share.items() for v in (d, [float(x) for x in s])]) if share else F.lit(None).cast("map<int,array<double>>")
    n = F.create_map(*[F.lit(v) for d, f in fits.items() for v in (d, f.n)]) if fits else F.lit(None).cast("map<int,long>")
    out = projected.select("id", "dim", "deviation", F.posexplode("w").alias("k", "whitened"))
    return out.select(
        F.col("id").alias(id_col),
        (F.col("k") + 1).alias("component"),
        F.try_element_at(n, "dim").cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.try_element_at(per_dim, "dim"), "k").alias("explained"),
        F.lit(_identity_error(projected, components)).cast("double").alias("identity_error"),
    )


def _identity_error(projected: DataFrame, components: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened values minus the identity."""
    w = [F.get("w", F.lit(a)) for a in range(components)]
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    moments = projected.groupBy("dim").agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(f"m{a}") for a, c in enumerate(w)],
        *[F.sum(w[a] * w[b]).alias(f"c{a}_{b}") for a, b in pairs],
    )
    worst = None
    for r in moments.collect():
        for a, b in pairs:
            if r[f"c{a}_{b}"] is not None:
                off = abs(r[f"c{a}_{b}"] / r.n - r[f"m{a}"] * r[f"m{b}"] / r.n**2 - (a == b))
                worst = off if worst is None else max(worst, off)
    return worst
