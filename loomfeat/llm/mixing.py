"""Mixing sources to target weights (operator 4): a time-varying curriculum.

Every source has a weight schedule over the run, a piecewise linear function on [0, 1].
Its integral is the source's weight in the whole mix: targets are shared out by it, each
held at ``max_repeat`` times the source's size and the excess reshared. The running
integral, scaled to the target, is the source's cumulative token demand; a document's
position is the moment at which the demand reaches the words in front of it in its
source's order, and documents are range-sorted by position.

Running sums are taken in two levels (buckets of a hash order, then inside a bucket), so
that a source with a third of all rows is spread over as many tasks as its rows need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeat.llm.common import col, materialise, packed

Knots = Sequence[tuple[float, float]]

#: Schedules dealt to the sources in order, repeating; their integrals are 3, 1 and 2.
SCHEDULES: list[Knots] = [
    [(0.0, 4.0), (1.0, 2.0)],
    [(0.0, 0.5), (1.0, 1.5)],
    [(0.0, 1.0), (0.5, 2.0), (1.0, 3.0)],
]


def integrate(knots: Knots) -> list[tuple[float, float, float, float]]:
    """Segments (start time, start weight, slope, integral so far) of a schedule."""
    out, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((float(t0), float(w0), (w1 - w0) / (t1 - t0), total))
        total += (w0 + w1) / 2 * (t1 - t0)
    return [*out, (1.0, float(knots[-1][1]), 0.0, total)]


def _invert(knots: Knots, share: Column) -> Column:
    """Time at which the running integral reaches ``share`` (0 to 1) of the whole."""
    segments = integrate(knots)
    area = share * F.lit(segments[-1][3])
    at = F.lit(1.0)
    for (t0, w0, slope, done), (_, _, _, until) in reversed(list(zip(segments, segments[1:]))):
        a = F.greatest(area - F.lit(done), F.lit(0.0))
        # w0 * x + slope / 2 * x^2 = a, in the form that also holds for a slope of zero
        x = F.try_divide(2 * a, F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * a, F.lit(0.0))))
        at = F.when(area <= F.lit(until), F.lit(t0) + F.coalesce(x, F.lit(0.0))).otherwise(at)
    return F.least(at, F.lit(1.0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, max_repeat: float) -> DataFrame:
    """Targets of the sources, in words: (source, source_size, rank, target).

    ``sizes`` has one row per source, so the order of sources is a plain window here. A
    source is full if its share at the final level exceeds its bound; since sources fill
    up in the order of bound to weight, the level follows from running sums in that order:
    it is the one at the first source that it does not fill, which is the highest such.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("rank", F.row_number().over(in_order) - 1)
        .withColumn("weight", weight)
        .withColumn("bound", F.lit(float(max_repeat)) * F.col("source_size"))
        .withColumn("fill", F.col("bound") / F.col("weight"))
    )
    levels = (
        ranked.withColumn("total", F.sum("source_size").over(whole) * F.lit(float(budget)))
        .withColumn("full", F.coalesce(F.sum("bound").over(by_fill), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_fill), F.lit(0.0)))
        .withColumn("level", F.try_divide(F.col("total") - F.col("full"), F.col("open")))
        .withColumn("final", F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(whole))
    )
    target = F.least(F.col("bound"), F.coalesce(F.col("final") * F.col("weight"), F.col("bound")))
    return levels.select("source", "source_size", "rank", target.alias("target"))


def mix(
    docs: DataFrame,
    keep: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    schedules: Sequence[Knots] = SCHEDULES,
    budget: float = 1.5,
    max_repeat: float = 2.0,
    bucket_rows: int = 2_000,
    ordered: bool = True,
) -> DataFrame:
    """The kept columns in ``doc``, size, source_size, target, taken and the document's passes.

    Sources go by code point (null last, a source of its own) and get the schedules in
    turn. A source whose target is r times its size is read floor(r) times whole and once
    up to the word at which the target is met: ``taken`` counts those words and ``passes``
    holds, for each time the document is read, its position in [0, 1] and the words read.
    Within a source documents go in the order of the md5 of their id, so reruns agree; rows that
    repeat an id are taken one after the other. Null and empty texts have size 0, are
    never taken and get no pass. The result is range-sorted by first position (none: last)
    if ``ordered``.
    """
    rows = docs.select(
        packed(keep).alias("doc"),
        col(source_col).alias("source"),
        # never null, so that the window and the join below share one exchange of the rows
        F.coalesce(F.concat(F.lit("="), col(source_col).cast("string")), F.lit("")).alias("place"),
        word_count(col(text_col)).alias("size"),
        F.md5(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"),
    )
    rows = materialise(rows, "mix-rows")
    n = rows.count()
    digits = 0  # hexadecimal digits of the key that make a bucket
    while n > bucket_rows * 16**digits:
        digits += 1
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))
    # two levels of buckets, so that the window over one source's buckets stays small
    buckets = rows.groupBy("source", "place", "bucket").agg(F.sum("size").alias("words"))
    outer = F.substring("bucket", 1, digits // 2)
    inner = Window.partitionBy("source", outer).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    coarse = buckets.groupBy("source", outer.alias("outer")).agg(F.sum("words").alias("words"))
    across = Window.partitionBy("source").orderBy("outer").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select("source", "outer", F.coalesce(F.sum("words").over(across), F.lit(0)).alias("base"))
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, [integrate(s)[-1][3] for s in schedules], budget, max_repeat)
    fine = buckets.select("source", "place", "bucket", outer.alias("outer"), F.coalesce(F.sum("words").over(inner), F.lit(0)).alias("before"))
    offsets = (
        fine.alias("f")
        .join(coarse.alias("c"), F.col("f.source").eqNullSafe(F.col("c.source")) & (F.col("f.outer") == F.col("c.outer")))
        .select("f.source", "f.place", "f.bucket", (F.col("f.before") + F.col("c.base")).alias("offset"))
    )
    offsets = (
        offsets.alias("o")
        .join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source")))
        .select("o.place", "o.bucket", "o.offset", "t.source_size", "t.rank", "t.target")
    )
    here = Window.partitionBy("place", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.drop("source").withColumn("within", F.coalesce(F.sum("size").over(here), F.lit(0)))
    joined = placed.join(offsets, ["place", "bucket"]).select("doc", "key", "size", "source_size", "rank", "target", (F.col("offset") + F.col("within")).alias("start"))

    goal = F.floor("target")
    most = int(-(-max_repeat // 1))
    words = lambda p: F.least(F.greatest(goal - F.lit(p) * F.col("source_size") - F.col("start"), F.lit(0)), F.col("size"))
    demand = lambda p: F.try_divide(F.lit(p) * F.col("source_size") + F.col("start"), F.col("target"))

    def position(p):
        out = _invert(schedules[-1], demand(p))
        for i, s in enumerate(schedules[:-1]):
            out = F.when(F.col("rank") % len(schedules) == i, _invert(s, demand(p))).otherwise(out)
        return out

    passes = F.array(*[F.when(words(p) > 0, F.struct(position(p).alias("position"), words(p).cast("long").alias("words"))) for p in range(most)])
    out = joined.select(
        "doc",
        "key",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        F.filter(passes, lambda x: x.isNotNull()).alias("passes"),
    ).withColumn("taken", F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x["words"]))
    if ordered:
        out = out.orderBy(F.try_element_at("passes", F.lit(1))["position"].asc_nulls_last(), "key")
    return out.drop("key")


def mixed(docs: DataFrame) -> DataFrame:
    """The digest rows of ``op4_mix`` (with every document's first position)."""
    out = mix(docs, ["doc_id"])
    return out.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    return F.array_join(F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), 1, n.cast("int")), "")


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The training order: one row for each reading of a document, by position.

    doc_id, source, position, words (of this reading), target and text, which ends with the
    last word read.
    """
    out = mix(docs, ["doc_id", "source", "text"], ordered=False, **options)
    rows = out.select("doc", "size", "target", F.explode("passes").alias("p"))
    text = F.col("doc.text")
    return rows.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.col("doc.source").alias("source"),
        F.col("p.position").alias("position"),
        F.col("p.words").alias("words"),
        "target",
        F.when(F.col("p.words") < F.col("size"), first_words(text, F.col("p.words"))).otherwise(text).alias("text"),
    ).orderBy("position", "doc_id")
