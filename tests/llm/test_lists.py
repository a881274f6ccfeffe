"""Token lists of the near-duplicate join stay short where many texts share a passage; what the driver holds."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from loomfeat.llm import jaccard, toxicity


def test_lists_of_lengthened_prefixes_are_short(spark, monkeypatch):
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in rng.integers(0, 10_000, 60)]
    texts = [" ".join([*passage, *(f"u{d}_{i}" for i in range(60))]) for d in range(24)]
    texts += [f"{texts[0]} more", f"{texts[5]} again"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    longest = []
    real = jaccard._shared_rows

    def shared_rows(rows):
        longest.append(rows.groupBy("token").count().agg(F.max("count")).first()[0])
        return real(rows)

    monkeypatch.setattr(jaccard, "_shared_rows", shared_rows)
    got = {r.id: r.component_id for r in jaccard.near_duplicates(docs, list_rows=8).collect()}
    assert got == {i: i for i in range(24)} | {24: 0, 25: 5}
    assert longest[0] <= 8  # 26 before: the passage's tokens behind the plain prefixes


def test_large_groups_make_no_rows_for_unlinked_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(100)]

    def changed(d, places):
        return " ".join(f"c{d}_{i}" if i in places else w for i, w in enumerate(base))

    # near copies of one text, then heavier variants of it, most of which link with nothing
    places = [rng.choice(np.arange(6, 94, 6), 1 if d < 30 else 3, replace=False) for d in range(70)]
    texts = [changed(d, set(p.tolist())) for d, p in enumerate(places)]
    texts += [changed(69, {*places[69].tolist(), 2}), changed(68, {*places[68].tolist(), 97})]
    sets = [set(s.tolist()) for s in jaccard.shingles([t.encode() for t in texts])]
    want = list(range(len(texts)))
    for _ in want:
        for a in range(len(sets)):
            for b in range(a):
                if len(sets[a] & sets[b]) * 100 >= len(sets[a] | sets[b]) * 80:
                    want[a] = want[b] = min(want[a], want[b])
    rows = []
    real = jaccard._across_families

    def across(*args):
        out = real(*args)
        rows.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_across_families", across)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.component_id for r in jaccard.near_duplicates(docs, list_rows=2).collect()}
    assert got == dict(enumerate(want)) and {68, 69} <= set(want)
    assert rows[0] < len(texts)  # hundreds before: the pairs that share enough of their prefixes


def test_blocks_count_shared_tokens(monkeypatch):
    monkeypatch.setattr(jaccard, "WIDTH", 7)
    rng = np.random.default_rng(5)
    left, right = ([np.unique(rng.integers(0, 60, n)) for n in rng.integers(0, 40, size)] for size in (9, 13))
    got = jaccard._shared(jaccard._ragged(left), jaccard._ragged(right))
    assert got.tolist() == [[len(set(a) & set(b)) for b in right] for a in left]
    kept = jaccard._forest(np.array([1, 1, 2, 5, 5, 1]), np.array([2, 2, 3, 6, 6, 3]))
    assert len(kept) == 3


def test_training_holds_a_part_of_the_sample(spark):
    class Sample:
        labels = [k % 2 for k in range(240)]
        sizes = [8 * 100_000] * 240

        def read(self):
            for k, y in enumerate(self.labels):
                buckets = np.arange(y, 100_000 + y, dtype=np.int32)
                yield k, buckets.tobytes() + np.full(100_000, 1e-5, np.float32).tobytes()

    tracemalloc.start()
    try:
        model = toxicity.train(Sample(), 0.5, epochs=1, batches=48)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.table) == 1 << toxicity.BITS
    assert peak < sum(Sample.sizes)  # beyond it before: the sample, and a fifth of it in doubles


def test_sample_needs_no_list_workers(spark, monkeypatch):
    from pyspark import SparkContext

    from loomfeat.llm import labels

    rows = [(k, f"text of row {k}") for k in ("a", "b", "c", "d")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").persist()
    marks = spark.createDataFrame([(k, i % 2) for i, (k, _) in enumerate(rows)], "doc_id string, toxic int").persist()
    docs.count(), marks.count()

    def parallelize(*args, **kwargs):
        raise AssertionError("a list is unpickled by Python workers under a daemon of their own")  # as before

    monkeypatch.setattr(SparkContext, "parallelize", parallelize)
    drawn = lambda some: sorted(labels.labelled_sample(docs, marks, "toxic", lambda i: some, (1, 9), lambda t: t))
    got = drawn(F.lit(True))
    assert [t for t, y in got if y == 1] == [b"text of row b", b"text of row d"]
    assert [t in (b"text of row a", b"text of row c") for t, y in got if y == 0] == [True]
    assert drawn(F.lit(False)) == []


def test_scoring_holds_small_pieces():
    model = toxicity.Model(np.random.default_rng(2).normal(0, 1, 1 << toxicity.BITS), 0.1, 0.0)
    texts = [" ".join(f"word{i * k % 997}" for i in range(400)).encode() for k in range(1, 400)]
    model.score(texts[:1])
    tracemalloc.start()
    try:
        scores = model.score(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.allclose(scores[:5], [model.score([t])[0] for t in texts[:5]], rtol=1e-12)
    assert peak < 8 << 20
