"""Scans and sinks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomfeat.functions.exprs import nan_to_null


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    fmt: str | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Scan a table with an explicit schema (CSV with header, or Parquet).

    Floating NaN values are turned into NULL at ingest (rule N8). A filter
    written on top of that projection is no longer pushed into the Parquet
    reader (it becomes an expression over the scrub), so row filters belong in
    ``where``: it is applied to the raw columns first, where Spark pushes it
    into the scan, and once more after the scrub, which drops rows whose NaN
    became NULL. The result equals filtering the scrubbed table.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") or path.endswith("/csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("header", "true").csv(path) if fmt == "csv" else reader.parquet(path)
    if where is None:
        return scrub_nan(df)
    return scrub_nan(df.where(where)).where(where)


def scrub_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL for every float/double column."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(nan_to_null(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def capped(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows (``read_csv(nrows=n)``); deterministic when ordered (top-k plan)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def projected(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """S3: ``usecols``: a projection that Catalyst pushes into the scan's ReadSchema."""
    return df.select(*columns)


def exact_sample(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows of any share of the table, repeatable: those of smallest key hash.

    Histograms of the hash narrow down where the ``n``-th row lies (``operators.selection``);
    the table is neither sorted nor shuffled, and no task merges ``n`` rows of each other.
    """
    from loomfeat.operators.selection import smallest

    return smallest(df, key, n, seed)


def fraction_sample(df: DataFrame, fraction: float, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """S4 (approximate size): keep rows whose key hash falls below ``fraction``; no shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    h = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(1_000_000))
    return df.where(h < F.lit(int(fraction * 1_000_000)))


def read_ranked_list(spark: SparkSession, path: str, column: str = "feature", rank_column: str | None = None) -> list[str]:
    """A ranked feature list (best first). Only the small list of names reaches the driver."""
    df = spark.read.option("header", "true").csv(path)
    if rank_column:
        df = df.orderBy(F.col(rank_column).cast("double").desc(), F.col(column))
    return [r[0] for r in df.select(column).collect()]


def write_ranked_list(df: DataFrame, path: str, column: str = "feature", score: str = "importance") -> None:
    """Companion of S5: write (feature, importance) as one CSV."""
    df.select(column, score).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_scores(df: DataFrame, path: str, key: str, score: str, fmt: str = "csv") -> None:
    """Id + score sink (the ``submission`` file)."""
    out = df.select(F.col(key).cast("long").alias(key), F.col(score).cast("double").alias(score))
    w = out.write.mode("overwrite")
    (w.option("header", "true").csv(path) if fmt == "csv" else w.parquet(path))


def write_importance(df: DataFrame, path: str) -> None:
    """Feature-importance sink."""
    df.write.mode("overwrite").option("header", "true").csv(path)
