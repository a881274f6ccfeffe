"""Training rows of labelled documents: all of them, or bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import as_bytes, col, map_docs, materialise, parts, small_batches, unpack


#: Bytes of features that the driver fetches at a time.
FETCHED = 4 << 20


class Sample:
    """Labels and sizes of the drawn rows, in order; their features are read from a table."""

    def __init__(self, found: DataFrame):
        rows = sorted(found.select("i", "y", F.octet_length("x")).collect())
        self.place = {i: k for k, (i, _, _) in enumerate(rows)}
        self.labels, self.sizes = [y for _, y, _ in rows], [size for _, _, size in rows]
        self.found = found

    def read(self) -> Iterator[tuple[int, bytes]]:
        """(place in the order, features), in any order, a few at a time."""
        some = self.found.select("i", "x").repartition(sum(self.sizes) // FETCHED + 1)
        for r in some.toLocalIterator():
            yield self.place[r.i], r.x


def labelled_sample(*args) -> list[tuple[bytes, int]]:
    """The drawn rows of ``drawn_features`` as a list, for features that are small."""
    sample = drawn_features(*args)
    held = dict(sample.read())
    return [(bytes(held[k]), y) for k, y in enumerate(sample.labels)]


def drawn_features(docs: DataFrame, labels: DataFrame, label: str, training, per_class: tuple[int, int], features: Callable[[bytes], bytes]) -> Sample:
    """The features of at most ``per_class[y]`` whole texts of each label y (0, 1), in hash order of the id.

    Rows are drawn after labels have met their texts, whatever the length of these. Only ids
    that fulfil ``training`` are drawn. Rows with a null label, id or text teach nothing; an
    id that repeats is drawn once for each of its different texts. ``features`` runs in the tasks:
    the driver holds numbers of rows and of features that the input does not change.
    """
    small_batches(docs.sparkSession)
    marked = labels.select(col("doc_id").alias("id"), col(label).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & training(F.col("id")))
    texts = docs.select(col("doc_id").alias("id"), col("text").cast("binary").alias("t")).where(F.col("id").isNotNull() & F.col("t").isNotNull()).withColumn("k", F.xxhash64("t"))
    # ids and hashes only: no text is sorted or moved before the rows are known
    keys = materialise(texts.select("id", "k").join(marked.distinct(), "id").distinct(), f"{label}-keys")
    order = [F.xxhash64("id"), F.col("id"), F.col("k")]
    drawn = [r for y in (0, 1) for r in keys.where(F.col("y") == y).orderBy(*order).limit(per_class[y]).collect()]
    # from an Arrow table: a list would be unpickled by Python workers under a daemon of their own, which stays in every executor
    rows = pa.table({"id": [r.id for r in drawn], "k": [r.k for r in drawn], "y": [r.y for r in drawn], "i": range(len(drawn))})
    place = docs.sparkSession.createDataFrame(rows, "id " + keys.schema["id"].dataType.simpleString() + ", k long, y int, i int")
    few = texts.join(F.broadcast(place), ["id", "k"]).select("i", "y", "t").dropDuplicates(["i"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in parts(batch)):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([features(t) for t in as_bytes(b.column(2))], pa.binary())], names=["i", "y", "x"])

    # written, so that the driver reads a few at a time and computes none of them twice
    return Sample(materialise(few.mapInArrow(run, "i int, y int, x binary"), f"{label}-features"))


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, training, features: Callable[[bytes], bytes]) -> DataFrame:
    """(id, k, y, x): the features x of every whole text of label y (0, 1) whose id fulfils ``training``.

    Rows with a null label, id or text teach nothing; an id that repeats is there once for
    each of its different texts (k is the text's hash) and labels. Features are made where the texts
    are, so that no text meets the labels.
    """
    marked = labels.select(col("doc_id").alias("id"), col(label).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & training(F.col("id")))
    texts = docs.select(col("doc_id").alias("id"), col("text").cast("binary").alias("t")).where(F.col("id").isNotNull() & F.col("t").isNotNull() & training(F.col("id"))).withColumn("k", F.xxhash64("t"))

    def run(batches):
        for (found,) in batches:
            yield [pa.array([features(t) for t in as_bytes(found)], pa.binary())]

    known = map_docs(texts, ["id", "k"], {"t": F.col("t")}, run, [T.StructField("x", T.BinaryType())])
    return known.select(*unpack(known, ["id", "k"]), "x").join(marked.distinct(), "id").dropDuplicates(["id", "k", "y"])
