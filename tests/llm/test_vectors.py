"""Whitening and the epsilon grid join against brute force and hand-made edge cases."""

import numpy as np
import pytest

from loomfeat.llm import epsilon_grid, whitening
from loomfeat.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, dim string, v string, n string, `k.x` string"
CLASH = ("d", "e", "f", "g")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)


# ---------------------------------------------------------------- 11


def whiten_by_hand(x, components=8):
    n, sums = len(x), x.sum(0)
    cov = np.array([[n * int(a @ b) - int(a.sum()) * int(b.sum()) for a in x.T] for b in x.T], float) / n**2
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    return (n * x - sums).astype(object), (x - sums / n) @ axes / np.sqrt(e), e / np.trace(cov)


def test_whitening_equals_brute_force(spark):
    out = QUERIES["op11_whitening"](spark, SMALL).toPandas()
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.floor(1024 * np.stack(vectors.embedding.to_numpy()).astype(float)).astype(np.int64) + 100_000
    away, whitened, explained = whiten_by_hand(x)
    assert len(out) == 8 * len(x) and out.n.eq(len(x)).all() and out.identity_error.max() < 1e-9
    for k in range(8):
        own = out[out.component == k + 1].sort_values("vec_id")
        assert own.vec_id.tolist() == vectors.vec_id.tolist()
        assert own.deviation.tolist() == [int(v) for v in (away * away).sum(1)]
        y = own.whitened.to_numpy()
        assert min(abs(y - whitened[:, k]).max(), abs(y + whitened[:, k]).max()) < 1e-9
        assert abs(own.explained.to_numpy() / explained[k] - 1).max() < 1e-9


def test_cross_products_are_exact():
    rng = np.random.default_rng(5)
    for bits, dim, n in ((1, 3, 70), (12, 5, 9000), (62, 4, 130)):
        rows = rng.integers(0, 1 << bits, (n, dim), dtype=np.uint64)
        both = whitening.CrossProducts(dim, bits)
        both.add(rows[: n // 3])
        both.add(rows[n // 3 :])
        got = {(i, j): sum(p << (whitening.LIMB * k) for k, p in enumerate(l)) for _, i, j, *l in zip(*both.rows().to_pydict().values())}
        own = rows.astype(object)
        assert got[-1, -1] == n
        for i in range(dim):
            assert got[i, -1] == own[:, i].sum()
            assert all(got[i, j] == (own[:, i] * own[:, j]).sum() for j in range(i, dim))


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), float(i % 5), -2000.0 * (i % 2)], 1) for i in range(20)]
    rows += [(7, [1.0, 2.0, 3.0], None), (None, [0.5, 0.25, 0.125], 2), (30, None, 1), (31, [], 1), (32, [nan, 1.0, 1.0], 1), (33, [None, 1.0, 1.0], 1), (34, [inf, 1.0, 1.0], 1)]
    rows += [(40, [1.0, 2.0], 1), (41, [1.0, 2.0], 1), (50, [1e30], 1), (51, [-1e30], 1)]
    out = whitening.digests(frame(spark, rows)).collect()
    by = {}
    for r in out:
        by.setdefault(r.vec_id, []).append(r)
    assert set(by) == {*range(20), None, 40, 41, 50, 51}
    assert len(by[7]) == 6 and len(by[0]) == 3 and len(by[40]) == 2 and len(by[50]) == 1
    assert all(r.n == 22 for i in (*range(20), None) for r in by[i])
    assert all(r.whitened is None and r.explained is None and r.deviation == 0 for i in (40, 41) for r in by[i])
    assert by[50][0].deviation is None and abs(abs(by[50][0].whitened) - 1) < 1e-9
    x = np.array([np.floor(1024 * np.array(v)) + 100_000 for i, v, _ in rows[:22]], np.int64)
    assert [by[i][0].deviation for i in range(7)] == [int(v) for v in (whiten_by_hand(x)[0] ** 2).sum(1)][:7]
    assert max(r.identity_error for r in out) < 1e-4
    assert whitening.digests(frame(spark, rows[:1])).first().whitened is None
    assert whitening.digests(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- 13


def links_by_hand(rows, threshold):
    live = [(i, np.array(v, float), c) for i, v, c in rows]
    n, root = [0] * len(live), list(range(len(live)))
    for a, (_, x, c) in enumerate(live):
        for b, (_, y, d) in enumerate(live):
            if a < b and c == d and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                n[a] += 1
                n[b] += 1
                ra, rb = root[a], root[b]
                root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    least = {r: min(live[k][0] for k in range(len(live)) if root[k] == r) for r in set(root)}
    return {live[k][0]: (n[k], least[root[k]]) for k in range(len(live))}


@pytest.mark.parametrize("interval, fan, threshold", [(4096, 8, 0.98), (16, 2, 0.98), (7, 3, 0.9), (200, 2, 0.6)])
def test_grid_join_equals_brute_force(spark, interval, fan, threshold):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 10))
    rows = []
    for i in range(400):
        v = centres[min(11, int(rng.exponential(3)))] + rng.normal(scale=rng.choice([0, 0.02, 0.15, 0.6]), size=10)
        rows.append((int(i * 37 % 401), [float(x) for x in v * rng.uniform(0.1, 5)], int(rng.integers(3))))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(90)]
    rows += [(2000 + i, [1.0, i / 900, 0.0], 1) for i in range(80)]
    out = epsilon_grid.near_duplicates(frame(spark, rows), threshold=threshold, interval=interval, fan=fan).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == links_by_hand(rows, threshold)
    assert len(out) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_grid_join_edges(spark):
    nan = float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [2.0, 0.001], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
        (6, None, 1), (7, [0.0, -0.0], 1), (8, [nan, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1),
        (12, [1e300, 1e300], 3), (13, [1e-300, 1e-300], 3), (None, [5.0, 5.0], 4), (None, [-1.0, 1.0], 5), (14, [3.0, 3.0], 4), (15, [-0.0, 1.0], 1),
    ]
    out = epsilon_grid.near_duplicates(frame(spark, rows)).collect()
    got = sorted((r.vec_id if r.vec_id is not None else 99, r.n_links, r.component_id if r.component_id is not None else 99, r.kept) for r in out)
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)]
    assert got == sorted(alone + [(1, 2, 1, True), (2, 2, 1, False), (2, 1, 2, True), (3, 2, 1, False), (12, 1, 12, True), (13, 1, 12, False), (15, 1, 2, False), (14, 1, 14, True), (99, 1, 14, False), (99, 0, 99, False)])
    assert epsilon_grid.near_duplicates(frame(spark, [])).count() == 0
    assert [r.kept for r in epsilon_grid.near_duplicates(frame(spark, [(1, None, 1)])).collect()] == [True]
