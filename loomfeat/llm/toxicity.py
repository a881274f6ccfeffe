"""Toxicity (operator 9): subword-bag embeddings averaged into a linear softmax.

A text is the bag of its words' character n-grams (word ends marked), hashed into a table
of vectors; their average goes through a linear softmax. Vectors and softmax are trained
jointly in numpy on a bounded sample of labelled rows, so that a misspelling never seen
shares most of its vectors with the word. As the softmax is linear in the average, a text
is scored with one number per n-gram, its vector's part of the logit.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import WORDS, as_bytes, col, held_out, map_docs, unpack
from loomfeat.llm.labels import Sample, drawn_features

GRAMS = (3, 4, 5, 6)
BITS = 17
CHUNK = 1 << 16


def gram_buckets(stream: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: (bucket, validity) of the n-gram at every byte of a blank-separated stream.

    ``stream`` begins and ends with a blank. A gram lies within one word and its two marks.
    """
    blanks = np.flatnonzero(stream == 0x20)
    after = np.repeat(blanks[1:], np.diff(blanks))  # the next blank behind each position
    at = np.arange(len(after))
    room = after - at
    h = stream[: len(after)].astype(np.uint32)
    wide = np.zeros(len(after) + max(GRAMS), np.uint32)
    wide[: len(stream)] = stream
    for n in range(2, max(GRAMS) + 1):
        h = h * np.uint32(0x01000193) ^ wide[n - 1 : n - 1 + len(after)]
        if n in GRAMS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * n)
            yield mixed >> np.uint32(32 - BITS), room >= n - 1


def pieces(text: bytes) -> Iterator[bytes]:
    """Blank-separated pieces of bounded length; cuts fall on blanks, so no gram is lost."""
    plain = text.translate(WORDS)
    at = 0
    while len(plain) - at > CHUNK:
        cut = plain.rfind(b" ", at, at + CHUNK)
        if cut <= at:
            cut = plain.find(b" ", at + CHUNK)
            if cut < 0:
                break
        yield plain[at:cut]
        at = cut
    yield plain[at:]


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares of its grams."""
    found = [b[ok] for p in pieces(text) for b, ok in gram_buckets(np.frombuffer(b" " + p + b" ", np.uint8))]
    buckets, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    return buckets.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)


def packed_bag(text: bytes) -> bytes:
    """The bag as one string: all buckets, then all shares, four bytes each."""
    buckets, shares = bag(text)
    return buckets.tobytes() + shares.tobytes()


class Model:
    """The logit of label 1: ``gain * mean(table[grams]) + bias``."""

    def __init__(self, table: np.ndarray, bias: float, empty: float):
        self.table, self.bias, self.empty = table, bias, empty

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
        batch: list[tuple[int, bytes]] = []
        size = 0

        def flush():
            stream = np.frombuffer(b" " + b" ".join(p for _, p in batch) + b" ", np.uint8)
            total, number = np.zeros(len(stream)), np.zeros(len(stream), np.int32)
            for buckets, ok in gram_buckets(stream):
                total[: len(buckets)] += np.where(ok, self.table[buckets], 0.0)
                number[: len(buckets)] += ok
            starts = np.cumsum([0] + [len(p) + 1 for _, p in batch])[:-1]
            who = [i for i, _ in batch]
            np.add.at(sums, who, np.add.reduceat(total, starts))
            np.add.at(counts, who, np.add.reduceat(number, starts))
            batch.clear()

        for i, text in enumerate(texts):
            for p in pieces(text or b""):
                batch.append((i, p))
                size += len(p) + 1
                if size >= CHUNK:
                    flush()
                    size = 0
        if batch:
            flush()
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(-(sums / np.maximum(counts, 1) + self.bias)))
        return np.where(counts > 0, p, self.empty)


def train(sample: Sample, share: float, dim: int = 8, epochs: int = 25, batches: int = 12, rate: float = 0.03, gain: float = 100.0, decay: float = 3e-4, seed: int = 9) -> Model:
    """Fit vectors and softmax jointly by Adam on mini-batches, then place the threshold.

    The sample's texts are read as packed bags, each put into its place as it arrives.
    ``share`` is the share of label 1 among all labelled rows, to which the sample is
    reweighted. A fifth of the sample is left out of the fit; the bias is moved so that a
    score of 0.5 separates it with the fewest errors. Without both labels every score is
    0, or 1 if all labels are 1.
    """
    y = np.array(sample.labels, np.int64)
    if len(set(y.tolist())) < 2:
        only = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(1 << BITS), 40.0 if only == 1 else -40.0, only)
    rng = np.random.default_rng(seed)
    fit = rng.permutation(len(y)) % 5 != 0
    order = rng.permutation(len(y))
    order = np.concatenate([order[fit[order]], order[~fit[order]]])
    y, n_fit = y[order], int(fit.sum())
    edge = np.append(0, np.cumsum(np.array(sample.sizes, np.int64)[order] // 8))
    idx, val = filed(edge[-1], np.int32), filed(edge[-1], np.float32)
    place = np.argsort(order)
    for k, packed in sample.read():  # the driver holds a mini-batch, the sample is in a file of its own
        at, n = slice(edge[place[k]], edge[place[k] + 1]), len(packed) // 8
        idx[at], val[at] = np.frombuffer(packed, np.int32, n), np.frombuffer(packed, np.float32, n, 4 * n) * np.float32(gain)
    owner = lambda i, j: np.repeat(np.arange(j - i, dtype=np.int32), np.diff(edge[i : j + 1]))
    prior = np.where(y == 1, share, 1 - share) / np.bincount(y, minlength=2)[y]
    weight = np.sqrt(prior / np.bincount(y, minlength=2)[y])  # between the labels' shares and equal parts
    vectors = rng.normal(0, 0.01, (1 << BITS, dim))
    softmax = rng.normal(0, 0.3, (dim, 2))
    bias = np.zeros(2)
    params, state = [vectors, softmax, bias], [[0.0, 0.0] for _ in range(3)]
    cuts = np.linspace(0, n_fit, batches + 1).astype(int)
    step = 0
    for epoch in range(epochs):
        for b in rng.permutation(batches):
            step += 1
            i, j = cuts[b], cuts[b + 1]
            at = slice(edge[i], edge[j])
            own, bucket, x = owner(i, j), idx[at], val[at]
            # with two classes the errors of a row are opposite, so both passes need one column
            part = vectors @ (softmax[:, 1] - softmax[:, 0])
            logit = np.bincount(own, x * part[bucket], j - i) + bias[1] - bias[0]
            error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y[i:j]) * weight[i:j] / weight[i:j].sum()
            back = np.bincount(bucket, x * error[own], 1 << BITS)
            inner = vectors.T @ back
            grads = [np.outer(back, softmax[:, 1] - softmax[:, 0]) + decay * vectors, np.stack([-inner, inner], 1), np.array([-error.sum(), error.sum()])]
            lr = rate * (1 - epoch / epochs)
            for p, g, s in zip(params, grads, state):
                s[0] = 0.9 * s[0] + 0.1 * g
                s[1] = 0.99 * s[1] + 0.01 * g * g
                p -= lr * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.99**step)) + 1e-8)
    part = vectors @ (softmax[:, 1] - softmax[:, 0])
    cuts = np.linspace(n_fit, len(y), batches + 1).astype(int)
    sums = [np.bincount(owner(i, j), val[edge[i] : edge[j]] * part[idx[edge[i] : edge[j]]], j - i) for i, j in zip(cuts[:-1], cuts[1:])]
    logit = np.concatenate(sums) + bias[1] - bias[0]
    return Model(part * gain, float(bias[1] - bias[0]) - threshold(logit, y[n_fit:], prior[n_fit:]), 0.0)


def filed(n: int, kind: type) -> np.ndarray:
    """An array of n zeros in a nameless temporary file, which goes with it."""
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, kind, "w+", shape=(n,)).view(np.ndarray) if n else np.zeros(0, kind)


def threshold(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut between two neighbouring logits with the least weight of errors (0 if one label)."""
    if len(set(y.tolist())) < 2:
        return 0.0
    order = np.argsort(logit, kind="stable")
    s, ones, w = logit[order], y[order], weight[order]
    cost = (np.cumsum(w * ones) + (w * (1 - ones)).sum() - np.cumsum(w * (1 - ones)))[:-1]
    best = np.flatnonzero(cost <= cost.min() * (1 + 1e-9))
    i = best[np.argmax(s[best + 1] - s[best])]
    return float((s[i] + s[i + 1]) / 2)


def score_toxicity(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept columns in ``doc`` and ``score``. Null, empty and wordless texts score 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for (texts,) in batches:
            # a few texts at a time: the batch itself is the most that a worker holds
            parts = [shared.value.score(as_bytes(texts.slice(i, 500))) for i in range(0, len(texts), 500)]
            yield [pa.array(np.concatenate([*parts, np.zeros(0)]), pa.float64())]

    return map_docs(docs, keep, {"t": text_col}, run, [T.StructField("score", T.DoubleType())])


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = (4_500, 1_500)) -> Model:
    """Train on at most ``sum(per_class)`` labelled rows that are not held out.

    The share of label 1 is counted over all of them.
    """
    training = lambda i: ~held_out(i, 5, 0)
    share = labels.where(training(col("doc_id")) & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0]
    return train(drawn_features(docs, labels, "toxic", training, per_class, packed_bag), float(share or 0.0))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest rows of ``op9_toxicity``."""
    out = score_toxicity(docs, fit_toxicity(docs, labels), ["doc_id"])
    return out.select(
        *unpack(out, ["doc_id"]),
        held_out(F.col("doc.doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
