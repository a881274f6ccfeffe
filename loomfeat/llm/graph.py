"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeat.llm.common import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component): the smallest vertex that links reach. Vertices are integers.

    Each round hangs every vertex's larger neighbours on its smallest one, then its
    smaller ones; the rounds grow with the logarithm of a component's diameter. Both steps
    are a minimum per vertex, combined before the shuffle, and a join on the vertex.
    """
    state = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        both = state.select("u", "v").union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        state = materialise(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = state.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
