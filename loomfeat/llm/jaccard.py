"""N-gram Jaccard join (operator 7) with adaptive multi-match prefixes.

A document is the set of its distinct 5-word shingles, as 64-bit hashes in the order of
the hash. Two sets of similarity 0.8 or more share tokens among the first tokens of each;
how many they must share grows with how far the two prefixes reach, so a pair is verified
only if it shares that many. The cost of a prefix is the length of its tokens' lists: a
token that more than ``list_rows`` prefixes hold is costly, and a document with costly
tokens gets a prefix longer by as many tokens, of which it must share as many more. By
that bound a pair always shares tokens that are not costly, and only those bring
documents together. Documents that have too few such tokens (members of very large groups
of near copies) are compared to the smallest member of each of their prefix lists first,
and then only across what is not yet one component. So are all others: a document meets
the smallest member of each of its lists first, and pairs are made only of documents that
this left in different components.

Documents with equal sets are one class from the start, represented by its smallest id.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import LOWER, as_bytes, col, map_docs, materialise, unpack
from loomfeat.llm.graph import components

#: Ids that may be broadcast (8 bytes each); larger id sets are joined by shuffle.
BROADCAST_IDS = 500_000
CHUNK = 1 << 17

#: Tokens of a block of whole sets, and those of them that are compared at a time.
BLOCK_TOKENS = 1 << 20
WIDTH = 1 << 12

#: Cheap tokens that are looked at behind a lengthened prefix, for each by which it is longer.
AHEAD = 8

# ---------------------------------------------------------------- shingles

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown as needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK + 1)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.multiply.accumulate(powers))
        return cls.up[:n], cls.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunk_shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    stream = np.frombuffer(b" ".join(texts).translate(LOWER) + b" ", np.uint8)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    edge = np.diff(np.concatenate([[0], (~_SPACE[stream]).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _Powers.get(len(stream))
    sums = np.zeros(len(stream) + 1, np.uint64)
    np.cumsum((stream.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    of = np.searchsorted(starts, bounds)  # first word of each document
    whole = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        whole = whole * np.uint64(0xD6E8FEB86659FD93) + words[j : j + len(whole)]
    whole = mixed(whole).view(np.int64)
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(whole[a : b - k + 1]))
        elif b > a:  # fewer words than a shingle: the sequence is one, marked by its length
            h = np.uint64(b - a)
            for w in words[a:b]:
                h = mixed(np.array([h]) * np.uint64(0xD6E8FEB86659FD93) + w)[0]
            out.append(np.array([h], np.uint64).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def shingles(texts: list[bytes | None], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0
    for t in texts:
        held.append(t or b"")
        size += len(held[-1]) + 1
        if size >= CHUNK:
            out += _chunk_shingles(held, k)
            held, size = [], 0
    return out + (_chunk_shingles(held, k) if held else [])


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set it links to."""
    return -(-percent * n // 100)


# ---------------------------------------------------------------- Spark side


def _sets(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(id, n, s1, s2, prefix): set size, a 128-bit digest of the set, its base prefix."""

    def run(batches):
        for (texts,) in batches:
            sets = shingles(as_bytes(texts), k)
            digests = [[mixed(s.view(np.uint64) ^ np.uint64(c)).sum(dtype=np.uint64) for s in sets] for c in (0x51ED270B, 0xC2B2AE3D27D4EB4F)]
            prefix = [s[: len(s) - least_overlap(len(s), percent) + 1] if len(s) else s for s in sets]
            yield [
                pa.array([len(s) for s in sets], pa.int32()),
                *[pa.array(np.array(d, np.uint64).view(np.int64)) for d in digests],
                _ragged(prefix),
            ]

    fields = [T.StructField("n", T.IntegerType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType()))]
    out = map_docs(docs.withColumn("_id", col(id_col).cast("long")), ["_id"], {"t": col(text_col)}, run, fields)
    return out.select(F.col("doc._id").alias("id"), "n", "s1", "s2", "prefix")


def _costly(rows: DataFrame, list_rows: int, hot_tokens: int) -> DataFrame:
    """The tokens that more than ``list_rows`` rows hold; if too many to send, those of the longest lists."""
    counted = rows.groupBy("token").count().where(F.col("count") > list_rows)
    return materialise(counted.orderBy(F.desc("count"), "token").limit(hot_tokens), "hot-tokens")


def _lists(docs: DataFrame, ids: DataFrame, hot: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(id, n, full, first, tail, whole) of documents with costly tokens.

    ``first``: their first cheap tokens, as many as a plain prefix has; all if there are
    fewer, and then ``full`` is set and ``whole`` is the set itself. ``tail``: those of
    ``first`` behind the plain prefix and ``AHEAD`` times as many cheap tokens, which would
    be listed if these were costly.
    """
    known = docs.sparkSession.sparkContext.broadcast(np.sort(hot.select("token").toArrow()["token"].to_numpy()))

    def run(batches):
        for (texts,) in batches:
            hots, out = known.value, [[], [], [], [], []]
            for s in shingles(as_bytes(texts), k):
                width = len(s) - least_overlap(len(s), percent) + 1 if len(s) else 0
                at = np.minimum(np.searchsorted(hots, s), max(0, len(hots) - 1))
                cheap = s[hots[at] != s] if len(hots) else s
                first, full = cheap[:width], len(cheap) < width
                longer = np.count_nonzero(first > s[width - 1]) if width else 0
                ahead = cheap[: width + AHEAD * longer]
                row = (len(s), full, first, ahead[ahead > s[width - 1]] if width else first, s[: len(s) * full])
                for c, v in zip(out, row):
                    c.append(v)
            yield [pa.array(out[0], pa.int32()), pa.array(out[1], pa.bool_()), *[_ragged(c) for c in out[2:]]]

    wanted = with_ids(docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("t")), ids, "left_semi")
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("n", T.IntegerType()), T.StructField("full", T.BooleanType()), *[T.StructField(c, longs) for c in ("first", "tail", "whole")]]
    out = map_docs(wanted, ["id"], {"t": F.col("t")}, run, fields)
    return out.where("n > 0").select(F.col("doc.id").alias("id"), *[f.name for f in fields])


def _lengthened(docs: DataFrame, base: DataFrame, hot: DataFrame, id_col: str, text_col: str, k: int, percent: int, list_rows: int, hot_tokens: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(costly tokens, ids of documents with one in their prefix, their ``_lists``; None if there are none).

    Tokens that only the longer prefixes hold may be costly themselves, with lists as long
    as a large group; prefixes are lengthened again until the pairs in such lists are fewer
    than a tenth of the rows. The first round only looks for these tokens and writes no lists.
    """
    looking = True
    while True:
        # an order of the tokens that all documents share, costly ones last, is what the bound rests on
        costly = materialise(with_ids(base, hot.select("token"), "left_semi", "token").select("id").distinct(), "costly")
        if costly.isEmpty():
            return hot, costly, None
        lists = _lists(docs, costly, hot, id_col, text_col, k, percent)
        lists = lists if looking else materialise(lists, "lists")
        more = _costly(lists.select(F.explode("tail").alias("token")), list_rows, hot_tokens)
        cost = more.agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0
        if not looking and (cost * 10 <= (lists.agg(F.sum(F.size("first"))).first()[0] or 0) or hot.count() >= hot_tokens):
            return hot, costly, lists
        if cost and hot.count() < hot_tokens:
            hot = materialise(hot.union(more).distinct(), "hot-tokens")
        looking = False


def _ragged(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(x) for x in arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def _tokens(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(columns of ``ids``, tokens) of the documents with the given ids, from their texts."""

    def run(batches):
        for (texts,) in batches:
            yield [_ragged(shingles(as_bytes(texts), k))]

    wanted = with_ids(docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("t")), ids, "inner")
    out = map_docs(wanted, ids.columns, {"t": F.col("t")}, run, [T.StructField("tokens", T.ArrayType(T.LongType()))])
    return out.select(*unpack(out, ids.columns), "tokens")


def with_ids(df: DataFrame, ids: DataFrame, how: str, key: str | list[str] = "id") -> DataFrame:
    """Semi or anti join with a written id table, broadcast only if counted within the bound."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


def _needed(na: Column, nb: Column, reach: Column, percent: int) -> Column:
    """Prefix tokens a linked pair must share: its least overlap, less what lies behind ``reach``."""
    whole = F.floor((percent * (na + nb) + 100 + percent - 1) / F.lit(100 + percent))
    return F.greatest(whole - reach + 1, F.lit(1))


def _least(n: Column, percent: int) -> Column:
    return F.floor((percent * n + 99) / F.lit(100))


def _enough(counted: DataFrame, percent: int) -> DataFrame:
    """Of (a, b, na, nb, fa, fb, shared) the pairs that share as many listed tokens as a link would need."""
    # a saturated side lists all its cheap tokens, so the other side's reach decides
    ta, tb = _least(F.col("na"), percent), _least(F.col("nb"), percent)
    reach = F.when(F.col("fa") & ~F.col("fb"), tb).when(F.col("fb") & ~F.col("fa"), ta).otherwise(F.greatest(ta, tb))
    return counted.where(F.col("shared") >= _needed(F.col("na"), F.col("nb"), reach, percent)).select("a", "b", "shared")


def _shared_rows(rows: DataFrame) -> DataFrame:
    """Rows whose token some other row holds too, with the smallest row of the token.

    A list is at most ``list_rows`` long (beyond ``hot_tokens`` costly tokens the window spills).
    """
    w = Window.partitionBy("token")
    least = F.min(F.struct("id", "n", "full")).over(w)
    return rows.select("*", F.count("*").over(w).alias("size"), least.alias("least")).where("size > 1").drop("size")


def _stars(shared: DataFrame, percent: int) -> DataFrame:
    """(a, b, shared): each document with the smallest members of its lists, if they share enough."""
    mine = shared.where("least.id < id").groupBy(
        F.col("least.id").alias("a"), F.col("id").alias("b"), F.col("least.n").alias("na"), F.col("n").alias("nb"), F.col("least.full").alias("fa"), F.col("full").alias("fb")
    )
    return _enough(mine.agg(F.count("*").alias("shared")), percent)


def _pairs_across(shared: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that share enough listed tokens; not both saturated."""
    ids = joined.select(F.col("vertex").alias("id"), "component")
    placed = shared.drop("least").join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left").withColumn("c", F.coalesce("component", "id"))
    w = Window.partitionBy("token")
    mixed_lists = placed.drop("component").withColumn("one", F.min("c").over(w) == F.max("c").over(w)).where("not one").drop("one")
    x, y = mixed_lists.alias("x"), mixed_lists.alias("y")
    na, nb = F.col("x.n"), F.col("y.n")
    near = (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (F.col("x.id") < F.col("y.id"))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.c") != F.col("y.c")) & near & F.expr("not (x.full and y.full)"))
    pair = met.groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b"), na.alias("na"), nb.alias("nb"), F.col("x.full").alias("fa"), F.col("y.full").alias("fb"))
    return _enough(pair.agg(F.count("*").alias("shared")), percent).select("a", "b")


def _verified_stars(stars: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """The (a, b) that are similar enough, each b having one a: every set is moved once."""
    tails = _tokens(docs, stars.select(F.col("b").alias("id"), "a"), id_col, text_col, k)
    heads = _tokens(docs, materialise(stars.select(F.col("a").alias("id")).distinct(), "star-heads"), id_col, text_col, k)
    both = tails.select("a", F.col("id").alias("b"), F.col("tokens").alias("tb")).join(heads.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a")
    return _similar(both, percent)


def _similar(both: DataFrame, percent: int) -> DataFrame:
    shared = F.size(F.array_intersect("ta", "tb"))
    return both.where(shared * 100 >= (F.size("ta") + F.size("tb") - shared) * percent).select("a", "b").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "pair-ids")
    sets = _tokens(docs, ids, id_col, text_col, k)
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a").join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
    return _similar(both, percent)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, list_rows: int = 64, hot_tokens: int = 500_000) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    component_id is the smallest id that links reach, the row's own included. A null,
    empty or wordless text has no shingles and links with nothing. A row with a null id
    links with nothing and has a null component. Equal texts link (if they have words);
    rows that repeat an id count as one document, each with its own n_shingles, that
    links by any of its texts.
    """
    sets = materialise(_sets(docs, id_col, text_col, k, percent), "sets")
    keyed = sets.where("n > 0 and id is not null")
    classes = materialise(keyed.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.count("*").alias("members")), "classes")
    copied = classes.where("members > 1").select("n", "s1", "s2", "rep")
    # rows of copied classes that do not represent them
    copies = materialise(sets.select("id", "n", "s1", "s2").join(copied, ["n", "s1", "s2"]).where("id <> rep").distinct(), "copies")
    reps = with_ids(keyed, copies.drop("rep"), "left_anti", ["id", "n", "s1", "s2"]).select("id", "n", "prefix")
    # an id with several texts may be a copy by one and represent another: it ties their classes
    ties = materialise(copies.select("id", "rep").join(reps.select("id").distinct(), "id", "left_semi").select(F.col("rep").alias("a"), F.col("id").alias("b")), "ties")

    base = reps.select(F.explode("prefix").alias("token"), "id", "n")
    hot = _costly(base, list_rows, hot_tokens)
    hot, costly, lists = _lengthened(docs, base, hot, id_col, text_col, k, percent, list_rows, hot_tokens)
    rows = with_ids(reps, costly, "left_anti").select(F.explode("prefix").alias("token"), "id", "n", F.lit(False).alias("full"))
    saturated = None
    if lists is not None:
        rows = rows.union(lists.select(F.explode("first").alias("token"), "id", "n", "full"))
        saturated = materialise(lists.where("full").select("id", "n", "whole"), "saturated")
    shared = materialise(_shared_rows(rows), "shared-tokens")
    stars = _stars(shared, percent)
    if saturated is not None:
        stars = stars.union(_to_smallest(saturated, percent))
    # the member that a document shares most with is the likeliest link
    first = materialise(stars.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a")).select("a", "b"), "stars")
    check = (id_col, text_col, k, percent)
    links = materialise(_verified_stars(first, docs, *check).union(ties), "links")
    joined = materialise(components(links), "components")
    rest = materialise(_pairs_across(shared, joined, percent).join(first, ["a", "b"], "left_anti"), "rest")
    more = [] if rest.isEmpty() else [_verified(rest, docs, *check)]
    if saturated is not None:
        more.append(_across_families(saturated, joined, percent))
    if more:
        joined = materialise(components(reduce(DataFrame.union, more, links)), "components")
    # component of a class, then of each of its rows
    member = copies.join(joined.withColumnRenamed("vertex", "rep"), "rep", "left").select("id", F.col("rep").alias("own"), F.coalesce("component", "rep").alias("component"))
    lone = joined.select(F.col("vertex").alias("id"), F.col("vertex").alias("own"), "component")
    placed = member.union(lone).groupBy("id").agg(F.min("component").alias("component"))
    return sets.join(placed, "id", "left").select("id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.least(F.coalesce("component", "id"), "id")).otherwise(F.col("id")).alias("component_id"))


def _to_smallest(saturated: DataFrame, percent: int) -> DataFrame:
    """Pairs of each document with the smallest one of its prefix lists, if they share enough."""
    rows = saturated.select(F.explode(_prefix(percent)).alias("token"), "id", "n")
    least = rows.groupBy("token").agg(F.min(F.struct("id", "n")).alias("m"))
    joined = rows.join(least, "token").where("m.id < id").groupBy(F.col("m.id").alias("a"), F.col("id").alias("b"), F.col("m.n").alias("na"), F.col("n").alias("nb")).agg(F.count("*").alias("shared"))
    reach = F.greatest(_least(F.col("na"), percent), _least(F.col("nb"), percent))
    return joined.where(F.col("shared") >= _needed(F.col("na"), F.col("nb"), reach, percent)).select("a", "b", "shared")


def _prefix(percent: int) -> Column:
    """The plain prefix of a ``whole`` set of ``n``."""
    return F.slice("whole", F.lit(1), (F.col("n") - _least(F.col("n"), percent) + 1).cast("int"))


def _across_families(saturated: DataFrame, joined: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """Links (a, b) of saturated documents in different components, enough to join what all of them join.

    Prefix lists that share a document make a family; a link never leaves one. Of a family
    the documents outside its largest component (few: heavier variants of a large group)
    are compared to all of it by their whole sets, block by block. A block returns a
    spanning forest of the components that its links join, so that its rows are fewer than
    the documents in it. Blocks hold ``block`` documents, up to 4 times as many in families
    of more than 64 blocks (a document is sent to fewer of them), and about ``BLOCK_TOKENS`` tokens.
    """
    rows = saturated.select(F.explode(_prefix(percent)).alias("token"), "id")
    least = rows.groupBy("token").agg(F.min("id").alias("m"))
    family = components(rows.join(least, "token").where("m < id").select(F.col("m").alias("a"), F.col("id").alias("b")).distinct())
    placed = saturated.join(family.select(F.col("vertex").alias("id"), F.col("component").alias("family")), "id")
    placed = placed.join(joined.select(F.col("vertex").alias("id"), F.col("component").alias("c")), "id", "left").withColumn("c", F.coalesce("c", "id"))
    placed = materialise(placed, "families")
    sizes = placed.groupBy("family", "c").agg(F.count("*").alias("count"), F.sum("n").alias("tokens")).groupBy("family").agg(
        F.max_by("c", F.struct("count", "c")).alias("big"),
        F.max(F.struct("count", "c", "tokens")).alias("most"),
        F.sum("count").alias("all"),
        F.sum("tokens").alias("tokens"),
        F.count("*").alias("kinds"),
    )
    held = F.least(F.greatest(F.col("all") / 64, F.lit(block)), F.lit(4 * block))
    blocks = lambda count, tokens: F.ceil(F.greatest(count / held, tokens / F.lit(BLOCK_TOKENS)))
    few, whole = (F.col("all") - F.col("most.count"), F.col("tokens") - F.col("most.tokens")), (F.col("all"), F.col("tokens"))
    sizes = sizes.where("kinds > 1").select("family", "big", blocks(*few).alias("na"), blocks(*whole).alias("nb"))
    sizes = materialise(sizes, "family-sizes")
    own = placed.join(sizes, "family")
    spread = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    cells = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    few = materialise(own.where("c <> big").select("family", spread("na").alias("x"), cells("nb").alias("y"), "id", "n", "c", "whole"), "few")
    all_ = materialise(own.select("family", cells("na").alias("x"), spread("nb").alias("y"), "id", "n", "c", "whole"), "all")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            (ia, na, ca), (ib, nb, cb) = ((t["id"].to_numpy(), t["n"].to_numpy().astype(np.int64), t["c"].to_numpy()) for t in (left, right))
            shared = _shared(left["whole"].combine_chunks(), right["whole"].combine_chunks())
            i, j = np.nonzero((shared * 100 >= (na[:, None] + nb[None, :] - shared) * percent) & (ca[:, None] != cb[None, :]))
            keep = _forest(ca[i], cb[j])
            a, b = np.minimum(ia[i], ib[j])[keep], np.maximum(ia[i], ib[j])[keep]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    keys = ["family", "x", "y"]
    return few.groupBy(*keys).cogroup(all_.groupBy(*keys)).applyInArrow(compare, "a long, b long").distinct()


def _shared(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """How many tokens each list of ``left`` shares with each of ``right``, a few tokens at a time."""
    known = np.unique(left.flatten().to_numpy())
    sides = []
    for lists in (left, right):
        tokens = lists.flatten().to_numpy()
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        there = known[at] == tokens
        order = np.argsort(at[there], kind="stable")
        sides.append((len(lists), row[there][order], at[there][order]))
    shared = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, len(known), WIDTH):
        dense = []
        for n, row, at in sides:
            i, j = np.searchsorted(at, (start, start + WIDTH))
            m = np.zeros((n, min(WIDTH, len(known) - start)), np.float32)
            m[row[i:j], at[i:j] - start] = 1
            dense.append(m)
        shared += (dense[0] @ dense[1].T).astype(np.int64)
    return shared


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of the edges (a, b) that join what those before them leave apart."""
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = v = root[root[v]]
        return v

    keep = []
    ends, place = np.unique(np.stack([a, b], 1), axis=0, return_index=True)
    for (u, v), k in zip(ends.tolist(), place.tolist()):
        u, v = find(u), find(v)
        if u != v:
            root[u] = v
            keep.append(k)
    return keep


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents (same columns) that are the smallest id of their component.

    Rows with a null id stay; of rows that repeat an id all stay that represent a component.
    """
    found = near_duplicates(docs, **options)
    gone = materialise(found.where("id <> component_id").select(F.col("id").alias("_gone")).distinct(), "gone")
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, docs[options.get("id_col", "doc_id")] == gone["_gone"], "left_anti")


def classes(docs: DataFrame) -> DataFrame:
    """The digest rows of ``op7_jaccard``."""
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
