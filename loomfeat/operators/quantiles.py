"""Exact per-group quantiles without holding a large group in one task.

Spark's ``percentile`` keeps a value -> count map per group and item, and merges the partial
maps of a group in one task: memory grows with the group's distinct values. Here groups go
by their number of rows, which one count of the keys tells:

* groups of ``GROUP_ROWS`` rows or fewer: the rows move once, as they are (each column
  once, each slice as a flag), to the task of their key, and no row is made for an item
  (``sorted_groups.statistics``);
* larger groups (few, by their size) are spread over tasks:

  1. rows become (group, item, value), one item per (column, slice) asked for, in one scan,
     and are counted per (group, item, bucket, value); the bucket is a non-decreasing function
     of the value, 32 to the octave, so a hot group is many buckets, and a value that most rows
     hold is one row;
  2. running counts inside each bucket, and of the buckets of each (group, item), add up to
     the run of ranks that a value covers: both are windows over bounded parts of a group;
  3. the ranks that a quantile needs (floor and ceiling of p * (n - 1)) are picked from the
     runs by a partial aggregate.

Both interpolate exactly as Spark's ``percentile`` does. The count of the keys is the only
job that runs while the plan is built; a whole table as one group needs none.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeat.operators.joins import null_safe_join
from loomfeat.operators.sorted_groups import GROUP_ROWS, large_groups, statistics

#: Buckets to the octave of a value's size.
PER_OCTAVE = 32


def value_bucket(v: Column) -> Column:
    """A whole number that never falls when ``v`` rises: sign and place of log2 |v|."""
    place = F.floor(F.least(F.log2(F.abs(v)) * PER_OCTAVE, F.lit(100_000.0))) + F.lit(100_000)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("int") * place).cast("int")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[tuple[str, Column, Column | None]],
    probs: Sequence[float],
    only: Mapping[str, Sequence[int]] | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Quantiles of several (name, value, where) items per group, one column per (item, p).

    Output columns: keys + ``<name>__q<i>`` for the i-th probability (NULL for a
    group whose item has no value); ``only`` names the probabilities of an item that are
    wanted as columns. Rows with a NULL key are a group, and a group without any value is not there.
    """
    keys, probs = list(keys), list(probs)
    if not keys or not items:
        return _by_buckets(df, keys, items, probs, only)
    flat = [(f"{name}__q{j}", value, where, float(probs[j])) for name, value, where in items for j in (only or {}).get(name, range(len(probs)))]
    large = large_groups(df, keys, group_rows)
    if large is None:
        return statistics(df, keys, flat, valued=True)
    small = statistics(null_safe_join(df, large, keys, "left_anti"), keys, flat, valued=True)
    return small.unionByName(_by_buckets(null_safe_join(df, large, keys, "left_semi"), keys, items, probs, only))


def _by_buckets(df: DataFrame, keys: list[str], items: Sequence[tuple[str, Column, Column | None]], probs: list[float], only: Mapping[str, Sequence[int]] | None) -> DataFrame:
    """The quantiles of groups of any size, by runs of ranks."""
    cells = []
    for idx, (_, value, where) in enumerate(items):
        v = value.cast("double")
        v = v if where is None else F.when(where, v)
        cells.append(F.struct(F.lit(idx).alias("__item"), v.alias("__v")))
    long = df.select(*keys, F.explode(F.array(*cells)).alias("__c")).select(*keys, "__c.__item", "__c.__v").where("__v is not null")
    group = [*keys, "__item"]
    part = [*group, "__b"]
    values = long.withColumn("__b", value_bucket(F.col("__v"))).groupBy(*part, "__v").agg(F.count(F.lit(1)).alias("__m"))
    inside = Window.partitionBy(*part).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    runs = values.withColumn("__in", F.coalesce(F.sum("__m").over(inside), F.lit(0)))
    buckets = runs.groupBy(*part).agg(F.sum("__m").alias("__t"))
    below = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    buckets = buckets.select(*part, F.coalesce(F.sum("__t").over(below), F.lit(0)).alias("__below"), F.sum("__t").over(whole).alias("__n"))
    runs = null_safe_join(runs, buckets, part, "inner").withColumn("__from", F.col("__below") + F.col("__in"))

    picked, wanted = [], F.lit(False)
    for j, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("__n") - 1)
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            covers = (F.col("__from") <= rank) & (rank < F.col("__from") + F.col("__m"))
            wanted = wanted | covers
            picked.append(F.max(F.when(covers, F.col("__v"))).alias(f"__{side}{j}"))
    q = runs.where(wanted).groupBy(*group).agg(F.max("__n").alias("__n"), *picked)

    def value_at(j: int, p: float) -> Column:
        pos = F.lit(float(p)) * (F.col("__n") - 1)
        lower, higher = F.floor(pos), F.ceil(pos)
        between = (higher - pos) * F.col(f"__lo{j}") + (pos - lower) * F.col(f"__hi{j}")
        return F.when(lower == higher, F.col(f"__lo{j}")).otherwise(between)

    q = q.select(*group, *[value_at(j, p).alias(f"__q{j}") for j, p in enumerate(probs)])
    return q.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("__item") == i, F.col(f"__q{j}"))).alias(f"{name}__q{j}")
            for i, (name, _, _) in enumerate(items)
            for j in (only or {}).get(name, range(len(probs)))
        ]
    )
