"""Helpers shared by the operators: tables, column carrying, written intermediates, byte words."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.session import scratch_dir

A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Where ``materialise`` notes its tables, while a caller wants to know them.
_NOTED: ContextVar[list[str] | None] = ContextVar("noted", default=None)


@contextmanager
def noting_tables(paths: list[str]) -> Iterator[None]:
    """Within it, the folders of written tables are added to ``paths``."""
    token = _NOTED.set(paths)
    try:
        yield
    finally:
        _NOTED.reset(token)


def drop_tables(spark: SparkSession, paths: list[str], needed: DataFrame) -> list[str]:
    """Delete written tables that ``needed`` does not read, and Spark's files of what is unreachable.

    If it reads one of them (its rows may then come from any), all stay and are returned.
    """
    read = {f.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") for f in needed.inputFiles()}
    kept = [p for p in paths if p.split(":", 1)[-1].strip("/") in read]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    if not kept:
        for p in paths:
            folder = jvm.org.apache.hadoop.fs.Path(p)
            folder.getFileSystem(conf).delete(folder, True)
        gc.collect()
        jvm.System.gc()  # shuffle files go when nothing refers to their stages any more
        return []
    return paths


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation) and is
    columnar and compressed, which a row checkpoint is not.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    if _NOTED.get() is not None:
        _NOTED.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch, and of a slice of one, that are worked on at a time.
PART_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Send the workers batches of ``PART_BYTES``, where the session sets no size of its own.

    Spark's 64 MB are held in each task by the writer's vectors (twice while they grow), by
    the worker and by its results.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(PART_BYTES))


def map_docs(
    df: DataFrame,
    keep: list[str],
    inputs: dict[str, Column | str],
    fn: Callable[[Iterator[tuple[pa.Array, ...]]], Iterator[list]],
    fields: list[T.StructField],
) -> DataFrame:
    """Run ``fn`` over Arrow batches and append its columns to a struct of kept columns.

    ``fn`` gets an iterator of tuples with the ``inputs`` columns of one batch and yields,
    for each batch, one list of arrays (the ``fields`` in order). It may read ahead, as
    long as the batches it yields keep order and length. Spark's batches arrive in slices,
    so that a worker holds one batch and the copies of a slice. The kept columns travel in the
    struct ``doc``, so their names cannot clash with the results'. An input given by its
    name is a plain column and is sent once, even if it is kept.
    """
    own = {n: keep.index(c) for n, c in inputs.items() if isinstance(c, str) and c in keep}
    sent = {n: col(c) if isinstance(c, str) else c for n, c in inputs.items() if n not in own}
    place = {n: i + 1 for i, n in enumerate(sent)}
    names = list(inputs)
    src = df.select(packed(keep).alias("doc"), *[c.alias(n) for n, c in sent.items()])
    schema = T.StructType([T.StructField("doc", src.schema["doc"].dataType), *fields])
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[pa.Array] = []

        def feed():
            for b in (part for batch in batches for part in parts(batch)):
                docs.append(b.column(0))
                yield tuple(b.column(0).field(own[n]) if n in own else b.column(place[n]) for n in names)

        for out in fn(feed()):
            yield pa.RecordBatch.from_arrays([docs.pop(0), *out], names=[f.name for f in schema.fields])

    return src.mapInArrow(run, schema)


def packed(columns: list[str]) -> Column:
    """A struct of the columns; of a filler only if there are none."""
    return F.struct(*[col(c) for c in columns]) if columns else F.struct(F.lit(0).alias("_"))


def unpack(df: DataFrame, columns: list[str]) -> list[Column]:
    """The kept columns of ``map_docs`` under their own names."""
    return [F.col("doc").getField(c).alias(c) for c in columns]


def as_bytes(texts: pa.Array) -> list:
    """Values of a string array as bytes objects (None stays), without decoding them."""
    return texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary()).to_pylist()


def _word_table() -> bytes:
    out = bytearray(b" " * 256)
    for b in range(256):
        if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
            out[b] = b
        elif 0x41 <= b <= 0x5A:
            out[b] = b + 32
    return bytes(out)


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``PART_BYTES`` (a row is never cut)."""
    rows = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


#: Lower-cases A-Z and turns every byte outside ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` into a blank.
WORDS = _word_table()

#: Lower-cases A-Z and nothing else.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, A_Z, A_Z.lower())


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True if crc32 of the id written as text leaves ``remainder`` (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
