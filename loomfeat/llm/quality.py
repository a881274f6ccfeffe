"""Quality classifier (operator 5): Bradley-Terry ranking of documents.

A document's merit is linear in features of its text. Pairs of one good and one bad
labelled document are preferences: the merit's weights minimise the logistic loss of the
pairs' feature differences. Every labelled row teaches: rows are dealt by hash into buckets of both
labels, pairs are made within a bucket, and each step of Newton's method is one pass over
the buckets that sums gradients and curvatures. The cut between good and bad is a quantile of the merits of
all labelled rows, and the score maps the cut to the contract's threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import as_bytes, held_out, map_docs, materialise, unpack
from loomfeat.llm.labels import labelled_features
from loomfeat.operators.quantiles import exact_quantiles

THRESHOLD = 0.3

_CLASSES = {  # bytes of a kind -> a mark, all others are dropped
    "upper": bytes(range(0x41, 0x5B)),
    "lower": bytes(range(0x61, 0x7B)),
    "digit": bytes(range(0x30, 0x3A)),
    "high": bytes(range(0x80, 0x100)),
    "stop": b".?",
    "comma": b",;:",
    "mark": b"!",
    "pipe": b"|",
    "symbol": b"#$%&*@^~_=+<>{}[]\\/",
    "line": b"\n",
}
_ALL = bytes(range(256))
_DROP = {k: bytes(b for b in _ALL if b not in v) for k, v in _CLASSES.items()}


def features(text: bytes) -> list[float]:
    """Shares and rates of a text; all zero for an empty one."""
    words = text.split()
    n, m = max(1, len(text)), max(1, len(words))
    count = {k: len(text.translate(None, drop)) for k, drop in _DROP.items()}
    lines = text.split(b"\n")
    distinct = len(set(words))
    same = sum(a == b for a, b in zip(words, words[1:]))
    upper = sum(w.isupper() for w in words)
    dirty = sum(not w[-1:].isalnum() and w[-1] < 0x80 and w[-1:] not in (b".", b",") for w in words)
    alone = sum(not w[:1].isalnum() and w[0] < 0x80 for w in words)
    return [
        *[count[k] / n for k in _CLASSES],
        upper / m,
        dirty / m,
        alone / m,
        same / m,
        distinct / m,
        np.log1p(distinct) / np.log1p(len(words)) if words else 0.0,
        np.sqrt(same / m),
        np.sqrt(upper / m),
        np.sqrt(dirty / m),
        np.sqrt(alone / m),
        len(set(lines)) / len(lines),
        n / m / 10,
        np.log1p(len(words)) / 10,
        np.log1p(n / len(lines)) / 10,
        count["stop"] / m,
        float(max(map(len, words), default=0) > 40),
    ]


class Model:
    def __init__(self, mean, scale, weights, cut, sharpness):
        self.mean, self.scale, self.weights, self.cut, self.sharpness = mean, scale, weights, cut, sharpness

    def merit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """1 / (1 + e^-z), with z such that a merit at the cut scores the threshold."""
        if not texts:
            return np.zeros(0)
        z = (self.merit(np.array([features(t or b"") for t in texts])) - self.cut) * self.sharpness
        return 1 / (1 + np.exp(-np.clip(z + np.log(THRESHOLD / (1 - THRESHOLD)), -40, 40)))


#: Rows of the rarer label in a bucket, on average.
BUCKET = 64
#: Weight of the squared weights in the loss.
RIDGE = 1e-4


def _buckets(rows: DataFrame, count: int) -> DataFrame:
    """(bucket, good, bad): the features of a bucket's rows of each label, one after the other."""

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("y", "ascending"), ("id", "ascending"), ("k", "ascending")])
        y, x = t["y"].to_numpy(), t["x"].to_pylist()
        sides = [b"".join(v for v, c in zip(x, y) if c == label) for label in (1, 0)]
        return pa.table({"bucket": t["bucket"][:1], "good": pa.array(sides[:1], pa.binary()), "bad": pa.array(sides[1:], pa.binary())})

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "k"), F.lit(count)))
    return dealt.groupBy("bucket").applyInArrow(pack, "bucket long, good binary, bad binary")


def _each(width: int):
    """A reader of batches of buckets: (bucket, features of its good rows, of its bad ones)."""

    def read(batches):
        for batch in batches:
            for bucket, *sides in zip(*(c.to_pylist() for c in batch.columns)):
                yield bucket, *[np.frombuffer(s, np.float64).reshape(-1, width) for s in sides]

    return read


def _summed(buckets: DataFrame, width: int, part) -> np.ndarray:
    """The sum of ``part(bucket, good, bad)``, a vector, over all buckets; a task sends one."""
    read = _each(width)

    def run(batches):
        total = None
        for each in read(batches):
            v = part(*each)
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    return np.sum([np.frombuffer(r.s, np.float64) for r in buckets.mapInArrow(run, "s binary").collect()], axis=0)


def train(rows: DataFrame, partners: int = 8, steps: int = 30, seed: int = 5) -> Model:
    """Fit the pairwise loss on all ``rows`` (id, k, y, x: packed features); the cut leaves as many merits below it as rows are bad.

    Every row meets ``partners`` random ones of the other label in its bucket. Without both labels
    there are no pairs: all weights are 0 and every text scores above the threshold unless all are bad.
    """
    width = len(features(b""))
    number = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(number) < 2:
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 1.0 if 0 in number else -1.0, 1.0)
    buckets = materialise(_buckets(rows, max(1, min(number.values()) // BUCKET)), "quality-buckets")
    n = sum(number.values())
    both = _summed(buckets, width, lambda _, good, bad: np.concatenate([good.sum(0) + bad.sum(0), (good * good).sum(0) + (bad * bad).sum(0)]))
    mean = both[:width] / n
    scale = np.sqrt(np.maximum(both[width:] / n - mean * mean, 0)) + 1e-6

    def slopes(w: np.ndarray):
        def part(bucket: int, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
            if not len(good) or not len(bad):
                return np.zeros(2 + width + width * width)
            rng = np.random.default_rng([seed, bucket])
            a = np.concatenate([np.repeat(np.arange(len(good)), partners), rng.choice(len(good), len(bad) * partners)])
            b = np.concatenate([rng.choice(len(bad), len(good) * partners), np.repeat(np.arange(len(bad)), partners)])
            diff = (good[a] - bad[b]) / scale
            lead = diff @ w
            p = 1 / (1 + np.exp(np.clip(lead, -40, 40)))
            return np.concatenate([[len(diff), np.logaddexp(0, -lead).sum()], -p @ diff, ((diff * (p * (1 - p))[:, None]).T @ diff).ravel()])

        total = _summed(buckets, width, part)
        pairs = max(total[0], 1.0)
        return total[1] / pairs + RIDGE / 2 * w @ w, total[2 : 2 + width] / pairs + RIDGE * w, total[2 + width :].reshape(width, width) / pairs + RIDGE * np.eye(width)

    w = np.zeros(width)
    loss, slope, curve = slopes(w)
    step = -np.linalg.solve(curve, slope)
    for _ in range(steps):
        tried = slopes(w + step)
        if tried[0] > loss:
            step = step / 2
            continue
        w, gain = w + step, loss - tried[0]
        loss, slope, curve = tried
        if gain < 1e-7:
            break
        step = -np.linalg.solve(curve, slope)

    read = _each(width)

    def merits(batches):
        for _, good, bad in read(batches):
            m = np.concatenate([(x - mean) / scale @ w for x in (good, bad)])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat([1, 0], [len(good), len(bad)]), pa.int32()), pa.array(m)], names=["y", "m"])

    found = materialise(buckets.mapInArrow(merits, "y int, m double"), "quality-merits")
    below = min(max(number[0], 1), n - 1)  # between this many merits and the others
    cut = exact_quantiles(found, [], [("m", F.col("m"), None)], [(below - 0.5) / (n - 1)]).first()[0]
    average = {r.y: r.m for r in found.groupBy("y").agg(F.avg("m").alias("m")).collect()}
    return Model(mean, scale, w, float(cut), 8.0 / max(average[1] - average[0], 1e-6))


def fit_quality(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on all labelled rows that are not held out."""
    training = lambda i: ~held_out(i, 5, 0)
    return train(materialise(labelled_features(docs, labels, "quality", training, lambda t: np.array(features(t), np.float64).tobytes()), "quality-features"))


def score_quality(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept columns in ``doc`` and ``score`` in (0, 1). A null text scores as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for (texts,) in batches:
            yield [pa.array(shared.value.score(as_bytes(texts)), pa.float64())]

    return map_docs(docs, keep, {"t": text_col}, run, [T.StructField("score", T.DoubleType())])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest rows of ``op5_quality``."""
    out = score_quality(docs, fit_quality(docs, labels), ["doc_id"])
    return out.select(
        *unpack(out, ["doc_id"]),
        held_out(F.col("doc.doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
