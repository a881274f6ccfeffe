"""Embedding near-dedup (operator 13): epsilon grid order join on leading principal dimensions.

Vectors are scaled to length one, where a cosine of at least t is a distance of at most
eps = sqrt(2 - 2t). Equal vectors of a label become one class first, so that a group of
copies is one row with a count. Classes are sorted by label and by the grid cells, of side
eps, of their leading principal coordinates, and the sequence is cut into intervals of a
fixed number of rows. Pairs of intervals are found by recursion over a directory of ever
shorter intervals: a pair whose boxes lie farther than eps apart, or whose labels cannot
meet, is skipped with all below it. The pairs that remain are joined in tasks that hold two
intervals each, where the recursion goes on down to short runs of rows; runs that are
provably within eps of each other throughout are linked without comparing them. A task
returns sums of links per class and a spanning forest of the links it found, so its output
is bounded by its rows, not by the pairs.

Vectors that are null, zero, or hold null or non-finite components, and rows without a
label, link with nothing; vectors of different lengths never link. Rows that repeat an id
are vectors of their own, and a null id is the smallest of no component (such a row alone
has a null component and is not kept). Empty tables give no rows. Other columns of the
table, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeat.llm.common import col, materialise, small_batches
from loomfeat.llm.graph import components
from loomfeat.llm.whitening import by_length, fit, whole_entries
from loomfeat.operators.scoring import prefix_rank

#: Leading principal dimensions that make grid cells and boxes.
LEADING = 8
#: Rows of an interval, rows of a run (split no further), and intervals under one entry of the directory.
INTERVAL, RUN, FAN = 4096, 64, 8


def reach(threshold: float) -> float:
    """The greatest distance of unit vectors with a cosine of ``threshold`` or more, rounding included."""
    return float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold) + 1e-12))


def keyed_rows(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v, key): key, a digest of the vector, is null where the vector links with nothing."""
    vector = col(vector_col)
    d = F.transform(vector, lambda x: x.cast("double"))
    takes_part = whole_entries(vector, 0.0, 0).isNotNull() & F.coalesce(F.exists(d, lambda x: x != 0), F.lit(False)) & col(label_col).isNotNull()
    kind = table.schema[vector_col].dataType.elementType.simpleString()
    if kind == "double":  # so that squares neither overflow nor vanish
        top = F.array_max(F.transform(d, F.abs))
        v = F.when((top > 1e100) | (top < 1e-100), F.transform(d, lambda x: x / top)).otherwise(vector)
    else:
        kind, v = "float", vector.cast("array<float>")
    small_batches(table.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            flat, there = v.flatten().to_numpy() + 0.0, v.is_valid().to_pylist()  # -0.0 becomes 0.0
            ends = np.concatenate([[0], np.cumsum(v.value_lengths().fill_null(0).to_numpy())])
            keys = [hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() if ok else None for a, b, ok in zip(ends, ends[1:], there)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["id", "label", "v", "key"])

    rows = table.select(col(id_col).cast("long").alias("id"), F.when(takes_part, col(label_col).cast("string")).alias("label"), F.when(takes_part, v).alias("v"))
    return rows.mapInArrow(run, f"id long, label string, v array<{kind}>, key binary")


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return v / np.sqrt((v * v).sum(1))[:, None]


def coordinates(u: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """What the leading axes leave of each unit vector, then its coordinates on them.

    Distances of these never exceed those of the vectors, whatever the orthonormal axes.
    """
    on = u @ axes
    return np.hstack([np.sqrt(np.maximum(0.0, 1.0 - (on * on).sum(1)))[:, None], on])


def grid_order(classes: DataFrame, threshold: float) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The classes with their place ``seq`` in grid order (from 1), and the axes of each vector length."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, _, v in by_length(batch.column(0)):
                x = np.floor(unit(v) * 1024.0).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.arange(0, x.size + 1, dim, dtype=np.int32), pa.array(x.ravel()))], names=["x"])

    axes = {dim: f.axes[:, :LEADING] for dim, f in fit(classes.select("v").mapInArrow(whole, "x array<long>")).items()}
    side = reach(threshold)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, v in by_length(batch.column(batch.schema.get_field_index("v"))):
                grid = np.floor(coordinates(unit(v), axes[dim]) / side).astype(np.int64) + (1 << 31)
                part = batch.take(pa.array(at))
                names = pa.array([g.tobytes() for g in grid.astype(">u4")], pa.binary())  # bytes sort as the cells do
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(at), dim, np.int32)), names], names=[*part.schema.names, "dim", "cells"])

    placed = classes.mapInArrow(cells, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema) + ", dim int, cells binary")
    return prefix_rank(placed, [], ["dim", "label", "cells", "key"], "seq").drop("cells"), axes


def packed_intervals(placed: DataFrame, axes: dict[int, np.ndarray], interval: int) -> DataFrame:
    """One row per interval of the sequence and vector length: its box, its label range and its rows, packed.

    Boxes are columns lo0, hi0, ...; a coordinate that short vectors lack is null.
    """
    width = LEADING + 1
    box = [f"{side}{k}" for k in range(width) for side in ("lo", "hi")]

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("seq").combine_chunks()
        (dim, _, v) = next(by_length(t["v"].chunk(0)))
        at = coordinates(unit(v), axes[dim])
        ends = {f"{side}{k}": None if k >= at.shape[1] else float(getattr(at[:, k], how)()) for k in range(width) for side, how in (("lo", "min"), ("hi", "max"))}
        labels, codes = np.unique(np.array(t["label"].to_pylist(), object), return_inverse=True)
        columns = {
            "place": t["place"][:1],
            "dim": t["dim"][:1],
            "l_lo": t["label"][:1],
            "l_hi": t["label"][-1:],
            **{c: pa.array([ends[c]], pa.float64()) for c in box},
            "labels": pa.array([labels.tolist()], pa.list_(pa.string())),
            "codes": pa.array([codes.astype(np.int64).tobytes()], pa.binary()),
            "seqs": pa.array([t["seq"].to_numpy().tobytes()], pa.binary()),
            "numbers": pa.array([t["number"].to_numpy().tobytes()], pa.binary()),
            "vectors": pa.array([v.tobytes()], pa.binary()),
        }
        return pa.table(columns)

    schema = "place long, dim int, l_lo string, l_hi string, " + ", ".join(f"{c} double" for c in box) + ", labels array<string>, codes binary, seqs binary, numbers binary, vectors binary"
    cut = placed.select("dim", "label", "number", "v", "seq", F.expr(f"(seq - 1) div {interval}").alias("place"))
    return cut.groupBy("place", "dim").applyInArrow(pack, schema)


def near_pairs(intervals: DataFrame, rows: int, threshold: float, interval: int, fan: int) -> DataFrame:
    """(a, b), a <= b: places of intervals that may hold links, by recursion from the whole sequence.

    Each round goes from pairs of long intervals to pairs of their ``fan`` parts and drops
    what is provably too far apart.
    """
    coords = range(LEADING + 1)
    ends = intervals.select("place", "dim", "l_lo", "l_hi", *[f"{s}{k}" for k in coords for s in ("lo", "hi")])
    depth = 0
    while fan**depth * interval < rows:
        depth += 1
    pairs = intervals.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in reversed(range(depth + 1)):
        span = fan**level
        at = ends.groupBy(F.expr(f"place div {span}").alias("place")).agg(
            F.min(F.struct("dim", F.col("l_lo").alias("l"))).alias("first"),
            F.max(F.struct("dim", F.col("l_hi").alias("l"))).alias("last"),
            *[F.min(f"lo{k}").alias(f"lo{k}") for k in coords],
            *[F.max(f"hi{k}").alias(f"hi{k}") for k in coords],
        )
        if level < depth:
            parts = F.sequence(F.lit(0), F.lit(fan - 1))
            pairs = pairs.select((F.col("a") * fan).alias("a"), F.explode(F.transform(parts, lambda i: F.col("b") * fan + i)).alias("b"))
            pairs = pairs.select(F.explode(F.transform(parts, lambda i: F.col("a") + i)).alias("a"), "b").where("a <= b")
        one, two = (at.select(*[F.col(c).alias(f"{side}_{c}") for c in at.columns]) for side in "ab")
        gaps = [F.greatest(F.lit(0.0), F.col(f"a_lo{k}") - F.col(f"b_hi{k}"), F.col(f"b_lo{k}") - F.col(f"a_hi{k}")) for k in coords]
        pairs = (
            pairs.join(one, F.col("a") == F.col("a_place"))
            .join(two, F.col("b") == F.col("b_place"))
            .where((F.col("a_first") <= F.col("b_last")) & (F.col("b_first") <= F.col("a_last")))
            .where(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= (reach(threshold) + 1e-9) ** 2)
            .select("a", "b")
        )
    return pairs


class Interval:
    """The rows of an interval in memory, with boxes, centres and radii of its runs."""

    def __init__(self, row: dict, axes: np.ndarray, kind: str):
        self.seqs, self.numbers = np.frombuffer(row["seqs"], np.int64), np.frombuffer(row["numbers"], np.int64)
        self.labels = np.array(row["labels"], object)[np.frombuffer(row["codes"], np.int64)]
        self.u = unit(np.frombuffer(row["vectors"], kind).reshape(len(self.seqs), -1))
        at = coordinates(self.u, axes)
        cut = np.arange(0, len(at), RUN)
        self.lo, self.hi = np.minimum.reduceat(at, cut), np.maximum.reduceat(at, cut)
        size = np.diff(np.append(cut, len(at)))
        self.centre = np.add.reduceat(self.u, cut) / size[:, None]
        away = self.u - np.repeat(self.centre, size, axis=0)
        self.radius = np.sqrt(np.maximum.reduceat((away * away).sum(1), cut))
        self.cut = np.append(cut, len(at))


def _merged(ends: np.ndarray, how) -> np.ndarray:
    return how.reduceat(ends, np.arange(0, len(ends), 2))


def near_runs(x: Interval, y: Interval, code: tuple[np.ndarray, np.ndarray], eps: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of runs (i of x, j of y) that may hold links: halves of halves, skipping distant ones.

    ``code`` are the rows' labels as numbers that rise along each interval.
    """
    levels = []
    boxes = [x.lo, x.hi, code[0][x.cut[:-1]][:, None], code[0][x.cut[1:] - 1][:, None]], [y.lo, y.hi, code[1][y.cut[:-1]][:, None], code[1][y.cut[1:] - 1][:, None]]
    while True:
        levels.append(boxes)
        if len(boxes[0][0]) == 1 and len(boxes[1][0]) == 1:
            break
        boxes = tuple([_merged(e, how) for e, how in zip(side, (np.minimum, np.maximum, np.minimum, np.maximum))] for side in boxes)
    i = j = np.zeros(1, np.int64)
    for depth, ((xl, xh, xa, xb), (yl, yh, ya, yb)) in enumerate(reversed(levels)):
        if depth:
            i, j = (np.concatenate(p) for p in ((2 * i, 2 * i, 2 * i + 1, 2 * i + 1), (2 * j, 2 * j + 1, 2 * j, 2 * j + 1)))
            there = (i < len(xl)) & (j < len(yl)) & ((i <= j) | (not same))
            i, j = i[there], j[there]
        gap = np.maximum(0.0, np.maximum(xl[i] - yh[j], yl[j] - xh[i]))
        near = ((gap * gap).sum(1) <= (eps + 1e-9) ** 2) & (xa[i] <= yb[j])[:, 0] & (ya[j] <= xb[i])[:, 0]
        i, j = i[near], j[near]
    return i, j


class Forest:
    """Roots of numbered rows under links, merged many links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (up := self.root[self.root]).tolist() != self.root.tolist():
                self.root = up


def join_intervals(x: Interval, y: Interval, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links of x's rows, links of y's rows, a, b): weighted numbers of links, and forest edges of seqs."""
    eps = reach(threshold)
    codes = np.unique(np.concatenate([x.labels, y.labels]), return_inverse=True)[1]
    cx, cy = codes[: len(x.seqs)], codes[len(x.seqs) :]
    forest, first = Forest(len(x.seqs) + (0 if same else len(y.seqs))), 0 if same else len(x.seqs)
    lx = np.zeros(len(x.seqs), np.int64)
    ly = lx if same else np.zeros(len(y.seqs), np.int64)
    i, j = near_runs(x, y, (cx, cy), eps, same)
    between = x.centre[i] - y.centre[j]
    whole = np.sqrt((between * between).sum(1)) + x.radius[i] + y.radius[j] <= np.sqrt(max(0.0, 2.0 - 2.0 * threshold)) - 1e-9
    whole &= (cx[x.cut[i]] == cx[x.cut[i + 1] - 1]) & (cy[y.cut[j]] == cy[y.cut[j + 1] - 1]) & (cx[x.cut[i]] == cy[y.cut[j]])
    whole &= ~((i == j) & same)
    for p, q in zip(i[whole], j[whole]):
        r, c = slice(x.cut[p], x.cut[p + 1]), slice(y.cut[q], y.cut[q + 1])
        lx[r] += y.numbers[c].sum()
        ly[c] += x.numbers[r].sum()
        rows, cols = np.arange(r.start, r.stop), first + np.arange(c.start, c.stop)
        forest.link(np.concatenate([rows, np.full(len(cols), rows[0])]), np.concatenate([np.full(len(rows), cols[0]), cols]))
    i, j = i[~whole], j[~whole]
    for p in np.unique(i):
        rows = np.arange(x.cut[p], x.cut[p + 1])
        cols = np.concatenate([np.arange(y.cut[q], y.cut[q + 1]) for q in j[i == p]])
        hit = (x.u[rows] @ y.u[cols].T >= threshold) & (cx[rows][:, None] == cy[cols])
        if same:
            hit &= rows[:, None] < cols
        lx[rows] += hit @ y.numbers[cols]
        np.add.at(ly, cols, x.numbers[rows] @ hit)
        r, c = np.nonzero(hit)
        if len(r):
            forest.link(rows[r], first + cols[c])
    seqs = x.seqs if same else np.concatenate([x.seqs, y.seqs])
    hung = np.flatnonzero(forest.root != np.arange(len(forest.root)))
    return lx, ly, seqs[hung], seqs[forest.root[hung]]


def found_links(intervals: DataFrame, pairs: DataFrame, axes: dict[int, np.ndarray], kind: str, threshold: float) -> DataFrame:
    """(a, b, links): numbers of links per class where b is null, else edges that connect what links connect."""
    names = ["labels", "codes", "seqs", "numbers", "vectors"]
    one, two = (intervals.select(*[F.col(c).alias(f"{side}_{c}") for c in ("place", "dim", *names)]) for side in "xy")
    cells = pairs.join(one, F.col("a") == F.col("x_place")).join(two, (F.col("b") == F.col("y_place")) & (F.col("x_dim") == F.col("y_dim")))
    small_batches(intervals.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(n, 1).to_pylist()[0] for n in range(batch.num_rows)):
                same = row["a"] == row["b"]
                x = Interval({c: row[f"x_{c}"] for c in names}, axes[row["x_dim"]], kind)
                y = x if same else Interval({c: row[f"y_{c}"] for c in names}, axes[row["x_dim"]], kind)
                lx, ly, a, b = join_intervals(x, y, threshold, same)
                seqs, links = (x.seqs, lx) if same else (np.concatenate([x.seqs, y.seqs]), np.concatenate([lx, ly]))
                seqs, links = seqs[links > 0], links[links > 0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([seqs, a])),
                        pa.array(np.concatenate([np.zeros_like(seqs), b]), mask=np.arange(len(seqs) + len(b)) < len(seqs)),
                        pa.array(np.concatenate([links, np.zeros_like(b)])),
                    ],
                    names=["a", "b", "links"],
                )

    return cells.drop("x_place", "y_place", "y_dim").mapInArrow(run, "a long, b long, links long")


def near_duplicates(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    interval: int = INTERVAL,
    fan: int = FAN,
) -> DataFrame:
    """One row per vector: id, n_links (other vectors linked directly), component_id, kept.

    Vectors link when their labels are equal and their cosine is ``threshold`` or more.
    """
    rows = materialise(keyed_rows(table, id_col, vector_col, label_col), "grid-rows")
    classes = rows.where("key IS NOT NULL").groupBy("label", "key").agg(F.min("id").alias("rep"), F.count("*").alias("number"), F.min("v").alias("v"))
    classes = materialise(classes, "grid-classes")
    placed, axes = grid_order(classes, threshold)
    placed = materialise(placed, "grid-order")
    intervals = materialise(packed_intervals(placed, axes, interval), "grid-intervals")
    kind = "float64" if placed.schema["v"].dataType.elementType.simpleString() == "double" else "float32"
    pairs = materialise(near_pairs(intervals, placed.count(), threshold, interval, fan), "grid-pairs")
    found = materialise(found_links(intervals, pairs, axes, kind, threshold), "grid-links")

    links = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    joined = components(found.where("b IS NOT NULL").select("a", "b"))
    members = placed.select("label", "key", "seq", "rep", "number").join(joined, F.col("seq") == F.col("vertex"), "left").withColumn("c", F.coalesce("component", "seq"))
    least = members.where("component IS NOT NULL").groupBy("c").agg(F.min("rep").alias("least"))
    members = members.join(least, "c", "left").join(links, F.col("seq") == F.col("a"), "left")
    members = members.select("label", "key", F.coalesce("least", "rep").alias("least"), (F.col("number") - 1 + F.coalesce("links", F.lit(0))).alias("n"))
    out = rows.select("id", "label", "key").join(members, ["label", "key"], "left")
    component = F.coalesce("least", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
