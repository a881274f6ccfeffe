"""Exact top-k inner-product search (operator 2): ball-tree branch and bound per shard.

Vectors are dealt into shards of bounded size and each shard becomes one ball tree, built
once and written. Queries go through the shards in blocks, in rounds of growing numbers of
shards: after each round every query's k-th best score so far goes along to the next, so
a shard starts with a bound that prunes. Inside a shard nodes are pruned from the root by
their inner-product upper bound (query times centre plus query norm times radius), leaves
are visited in the order of that bound, and the k-th score rises with every visit.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import col, materialise

LEAF = 64


class BallTree:
    """Nodes in breadth-first order: centre, radius, range of rows, first child (0: leaf)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        rows = np.arange(len(ids))
        centres, radii, ranges, child = [], [], [], []
        queue = [(0, len(rows))]
        while queue:
            below = []
            for a, b in queue:
                own = vectors[rows[a:b]]
                centre = own.mean(0)
                away = np.sqrt(((own - centre) ** 2).sum(1))
                centres.append(centre)
                radii.append(away.max())
                ranges.append((a, b))
                child.append(0)
                if b - a > LEAF:
                    far = own[away.argmax()]
                    along = own @ (own[((own - far) ** 2).sum(1).argmax()] - far)
                    half = (b - a) // 2
                    rows[a:b] = rows[a:b][np.argpartition(along, half)]
                    child[-1] = -1
                    below += [(a, a + half), (a + half, b)]
            first = len(child)
            for i in range(len(child) - len(queue), len(child)):
                if child[i]:
                    child[i] = first
                    first += 2
            queue = below
        self.ids, self.vectors = ids[rows], vectors[rows]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.ranges, self.child = np.array(ranges), np.array(child)

    def pack(self) -> bytes:
        return _pack([self.ids, self.vectors, self.centres, self.radii, self.ranges, self.child])

    @classmethod
    def unpack(cls, data: bytes) -> BallTree:
        tree = cls.__new__(cls)
        tree.ids, tree.vectors, tree.centres, tree.radii, tree.ranges, tree.child = _unpack(data)
        return tree

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, score) of up to k best rows per query that score at least its floor."""
        m = len(queries)
        norms = np.sqrt((queries**2).sum(1))
        bound = queries @ self.centres.T + np.outer(norms, self.radii)
        bound += 0.5 + 1e-9 * np.abs(bound)  # scores are whole numbers, rounding is far below one half
        kth = floor.astype(np.float64).copy()
        open_ = np.zeros(bound.shape, bool)
        open_[:, 0] = True
        for i, c in enumerate(self.child):
            open_[:, i] &= bound[:, i] >= kth
            if c:
                open_[:, c] = open_[:, c + 1] = open_[:, i]
        leaves = np.flatnonzero(self.child == 0)
        bound = np.where(open_[:, leaves], bound[:, leaves], -np.inf)
        best: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def visit(leaf: int, who: np.ndarray) -> None:
            a, b = self.ranges[leaves[leaf]]
            scores = queries[who] @ self.vectors[a:b].T
            r, c = np.nonzero(scores >= kth[who][:, None])
            row, found = who[r], self.ids[a:b][c]
            other = found != query_ids[row]
            held.append((row[other], found[other], scores[r, c][other]))

        def settle() -> None:
            row, found, score = (np.concatenate([x, *[h[i] for h in held]]) for i, x in enumerate(best))
            held.clear()
            order = np.lexsort((found, -score, row))
            row, found, score = row[order], found[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            keep = rank < k
            best[:] = [row[keep], found[keep], score[keep]]
            last = rank == k - 1
            kth[row[last]] = np.maximum(kth[row[last]], score[last])

        # first every query's own best leaves, then the rest by their greatest bound
        ranks = min(4, len(leaves))
        own = np.argsort(-bound, axis=1, kind="stable")[:, :ranks]
        seen = np.zeros(bound.shape, bool)
        for t in range(ranks):
            pick = own[:, t]
            live = np.flatnonzero(bound[np.arange(m), pick] >= kth)
            for leaf in np.unique(pick[live]):
                visit(leaf, live[pick[live] == leaf])
            seen[live, pick[live]] = True
            settle()
        bound[seen] = -np.inf
        for n, leaf in enumerate(np.argsort(-bound.max(0), kind="stable")):
            who = np.flatnonzero((bound[:, leaf] >= kth) & (bound[:, leaf] > -np.inf))
            if len(who):
                visit(leaf, who)
            if held and (n % 8 == 7 or sum(len(h[0]) for h in held) > 50_000):
                settle()
        if held:
            settle()
        return tuple(best)


def _pack(arrays: list[np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return out.getvalue()


def _unpack(data: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        return [z[f"arr_{i}"] for i in range(len(z.files))]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal-length integer lists as a matrix of doubles."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy().astype(np.float64)
    return flat.reshape(len(column), -1)


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, v): components as floor(scale * x), x as double; rows that take no part are left out."""
    v = F.transform(col(vector_col), lambda x: x.cast("double"))
    bad = F.exists("d", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        table.select(col(id_col).cast("long").alias("id"), v.alias("d"))
        .where(F.col("id").isNotNull() & F.col("d").isNotNull() & ~F.coalesce(bad, F.lit(True)))
        .select("id", F.transform("d", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v"))
    )


def top_k(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    k: int = 20,
    scale: float = 64.0,
    shard_rows: int = 8_192,
    block_rows: int = 4_096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest integer inner products of every query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows with
    another id and as many components; ties go to the smaller id. Rows with a null id, a
    null vector or a null or non-finite component take no part. Rows that repeat an id
    are candidates each; as a query the smallest of their vectors counts. Scores are exact
    up to 2^53.
    """
    vectors = materialise(whole_vectors(table, id_col, vector_col, scale).withColumn("dim", F.size("v")), "vectors")
    n = vectors.count()
    shards = max(1, -(-n // shard_rows))
    queries = vectors.where(F.pmod("id", F.lit(every)) == 0).groupBy("dim", "id").agg(F.min("v").alias("v"))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(max(1, -(-n // every // block_rows)))).cast("int"))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        tree = BallTree(group["id"].to_numpy(), _matrix(group["v"]))
        return pa.table({"dim": group["dim"][:1], "shard": group["shard"][:1], "tree": pa.array([tree.pack()], pa.binary())})

    trees = materialise(dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, tree binary"), "ball-trees")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found([], [], [])
        tree, ids = BallTree.unpack(left["tree"][0].as_py()), right["id"].to_numpy()
        row, found, score = tree.search(ids, _matrix(right["v"]), right["floor"].to_numpy(), k)
        return _found(ids[row], found, score.astype(np.int64))

    best = None
    start, width = 0, 1
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while start < shards:
        here = trees.where((F.col("shard") >= start) & (F.col("shard") < start + width))
        floor = F.lit(-(2.0**62))
        asked = queries
        if best is not None:
            kth = best.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("kth"))
            asked, floor = queries.join(kth, "id", "left"), F.coalesce("kth", floor)
        asked = asked.select("dim", "block", "id", "v", floor.alias("floor"), F.explode(F.sequence(F.lit(start), F.lit(min(shards, start + width) - 1))).alias("shard"))
        cells = queries.select((F.col("dim") + 0).alias("dim"), (F.col("block") + 0).alias("block")).distinct()
        # one cell of the grid is one tree and one block of queries
        grid = here.join(cells, "dim").select("dim", "shard", "block", "tree")
        keys = ["dim", "shard", "block"]
        found = grid.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score long")
        if best is not None:
            found = found.union(best.select("query_id", "vec_id", "score"))
        ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        start, width = start + width, width * 4
        best = materialise(ranked, "best") if start < shards else ranked
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _found(query, vec, score) -> pa.Table:
    return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.int64())})
