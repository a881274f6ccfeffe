"""Joins.

Only left equi-joins occur. No side carries a broadcast hint, except one-row statistics:
Spark broadcasts a side whose bytes, estimated or measured at run time, are below its
threshold, and AQE splits skewed partitions of the others.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` in which NULL keys match each other; the left side's keys stay."""
    right = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}" if c in keys else c) for c in right.columns])
    if not keys:
        return attach_one_row(left, right)
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__r_{k}`")) for k in keys]
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    return left.join(right, on, how).drop(*[f"__r_{k}" for k in keys])


def left_join(spine: DataFrame, block: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left equi-join of a feature block onto a spine."""
    return spine.join(block, on, "left")


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: str | Sequence[str], what: str = "frame") -> None:
    """Raise if a key combination repeats (one grouped pass, only offenders are fetched)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(5).collect()
    if dup:
        raise DuplicateKeyError(f"{what}: key {keys} repeats, e.g. {[tuple(r) for r in dup]}")


def unique_rows(df: DataFrame, on: str | Sequence[str], what: str = "frame") -> DataFrame:
    """``df`` itself, failing the job that reads it when a key combination repeats.

    The keys alone are counted, beside the rows: a frame of hundreds of columns is not
    taken through a window for it. No job of its own runs.
    """
    keys = [on] if isinstance(on, str) else list(on)
    k = F.struct(*[F.col(f"`{c}`") for c in keys])
    repeats = df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1").agg(F.min(F.to_json(k)).alias("__repeats"))
    message = F.concat(F.lit(f"{what}: key "), F.col("__repeats"), F.lit(" repeats"))
    checked = F.when(F.col("__repeats").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return attach_one_row(df, repeats).where(checked).drop("__repeats")


def validated_left_join(spine: DataFrame, block: DataFrame, on: str | Sequence[str], spine_checked: bool = False) -> DataFrame:
    """``merge(..., validate='one_to_one')``: both sides unique on the key, checked as the join runs.

    The result is unique on the key too: ``spine_checked`` says that the spine is such a result.
    """
    left = spine if spine_checked else unique_rows(spine, on, "left side")
    return left.join(unique_rows(block, on, "right side"), on, "left")


def join_chain(spine: DataFrame, blocks: Sequence[DataFrame], on: str) -> DataFrame:
    """Spine left-joined with every block on one key.

    Each block is already aggregated by the key, so each is hash-partitioned by
    it; Spark re-uses that partitioning and the spine is exchanged once per
    join at most (AQE coalesces the small ones).
    """
    out = spine
    for b in blocks:
        out = out.join(b, on, "left")
    return out


def propagate_label(child: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """``child[key].map(dict(key -> label))`` as a left join on the projection."""
    return child.join(labels.select(key, label), key, "left")


def lookup(df: DataFrame, dictionary: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join of a per-category dictionary; Spark broadcasts it if its bytes are few."""
    return df.join(dictionary, on, "left")


def dedupe_columns(left: DataFrame, right: DataFrame, on: str | Sequence[str], suffix: str = "_y") -> DataFrame:
    """Rename right-side columns that collide with the left side (pandas ``_x``/``_y``)."""
    on = {on} if isinstance(on, str) else set(on)
    clash = (set(left.columns) & set(right.columns)) - on
    for c in sorted(clash):
        right = right.withColumnRenamed(c, f"{c}{suffix}")
    return right


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (global statistics) to every row.

    An equi-join on a constant with the broadcast one-row side: no pairs are
    enumerated, every row of ``df`` meets exactly one row. ``one_row`` must be a global
    aggregate (one row by construction).
    """
    left = df.withColumn("__one", F.lit(1))
    right = F.broadcast(one_row.withColumn("__one", F.lit(1)))
    return left.join(right, "__one", "inner").drop("__one")
