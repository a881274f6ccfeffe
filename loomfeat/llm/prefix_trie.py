"""Conversation prefix trie (operator 12): a minimal-perfect-hash node table per shard.

A prefix is named by a digest of 2 x 62 bits: the sum, modulo 2^62, of its turns' SHA-256
words mixed with their positions. Sums can be taken piece by piece, so a conversation of any
length is spread over tasks. Grouping by digest gives the nodes; the group also holds the
least and greatest parent digest, depth and SHA-256 of the last turn, and a node for which
they differ would be two prefixes under one digest, which is an error, never a merged node.

Nodes are cut into units, each a subtree of bounded weight, and units are dealt into shards.
A shard numbers its nodes by a minimal perfect hash, checks each number against the digest
stored there, scatters counts into flat arrays by number, and adds every node to its parent's
number, deepest first. What a unit adds up to goes to its parent, a node above all units.
The nodes above are few (heavier than a unit); if they are many, because some conversation
is very long, they are cut into bands of depth: a band's sums hang in a small trie of bands,
whose totals are then handed down into each band.

Order and ties: turns go by ``turn`` (null first), turns of the same number by the SHA-256
of role and text; repeated rows are turns of their own. A null role or text is an empty one.
Rows without a conversation id are left out. An empty table has no nodes, not even a root.
Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeat.llm.common import col, materialise, small_batches
from loomfeat.operators.scoring import prefix_rank

#: Turns that one piece of a conversation holds.
PIECE = 4096
#: Turns below a unit's top, all members counted; also the nodes of a shard, about.
UNIT = 1 << 16
#: Depths of a band, where the nodes above all units are too many for one task.
BAND = 1024
#: Nodes above all units that are sent to every task at most.
BROADCAST_NODES = 100_000

_MASK = (1 << 62) - 1
_EMPTY = hashlib.sha256(b"").hexdigest()


def rebuilt(
    table: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    family: int = 100,
    heads: int = 6,
) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after each conversation c takes its first turns from c - c % family.

    With h = crc32(c) % heads, the first h turns (all, if fewer) of that conversation stand
    for c's own first h. conversations: (c, total); turns: (c, total, d, t, n) with position
    d from 1, SHA-256 t of role and text, and n code points of text.
    """
    role, text = (F.coalesce(col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    own = table.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("c"),
        col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("t"),
        F.length(text).cast("long").alias("n"),
    )
    own = materialise(own, "trie-turns")
    own = materialise(prefix_rank(own, ["c"], ["turn", "t"], "p"), "trie-ranked").withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % heads)
    first = own.where((F.col("p") < heads) & (F.col("c") % family == 0)).groupBy(F.col("c").alias("base")).agg(F.array_sort(F.collect_list(F.struct("p", "t", "n"))).alias("first"))
    convs = own.groupBy("c", "h").agg(F.max("p").alias("turns")).withColumn("base", F.col("c") - F.col("c") % family)
    head = F.coalesce(F.filter("first", lambda x: x["p"] <= F.col("h")), F.array())
    convs = convs.join(first, "base", "left").select("c", "h", "turns", head.alias("head")).withColumn("k", F.size("head"))
    convs = materialise(convs.withColumn("total", F.col("k") + F.greatest(F.lit(0), F.col("turns") - F.col("h"))), "trie-conversations")
    inherited = convs.select("c", "total", F.posexplode("head").alias("i", "x")).select("c", "total", (F.col("i") + 1).cast("long").alias("d"), "x.t", "x.n")
    # a long conversation's facts meet its turns piece by piece
    facts = convs.select("c", "k", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"turns div {PIECE}"))).alias("piece"))
    kept = own.where("p > h").withColumn("piece", F.expr(f"p div {PIECE}")).join(facts, ["c", "piece"])
    kept = kept.select("c", "total", (F.col("k") + F.col("p") - F.col("h")).cast("long").alias("d"), "t", "n")
    return convs.select("c", "total"), inherited.union(kept)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_digests(turns: DataFrame) -> DataFrame:
    """``turns`` with the digest (g1, g2) of the prefix that each ends, and (p1, p2) of the one before it."""
    small_batches(turns.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, carry = None, np.zeros(2, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            c, d = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            words = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64).reshape(-1, 4)[:, :2]
            step = _mixed(words ^ _mixed(d.astype(np.uint64))[:, None])
            run = np.cumsum(step, axis=0, dtype=np.uint64)
            piece = d // PIECE
            new = np.concatenate([[(c[0], piece[0]) != before], (c[1:] != c[:-1]) | (piece[1:] != piece[:-1])])
            start = np.maximum.accumulate(np.where(new, np.arange(len(c)), 0))
            base = run[start] - step[start]
            base[: len(c) if not new.any() else int(new.argmax())] -= carry
            run = run - base
            before, carry = (c[-1], piece[-1]), run[-1]
            ends = [(x & np.uint64(_MASK)).astype(np.int64) for x in (run[:, 0], run[:, 1], run[:, 0] - step[:, 0], run[:, 1] - step[:, 1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, ends)], names=["c", "total", "d", "t", "n", "g1", "g2", "p1", "p2"])

    dealt = turns.select("c", "total", "d", "t", "n").repartition("c", F.expr(f"d div {PIECE}")).sortWithinPartitions("c", "d")
    local = materialise(dealt.mapInArrow(sums, "c long, total long, d long, t binary, n long, g1 long, g2 long, p1 long, p2 long"), "trie-prefixes")

    def running(t: pa.Table) -> pa.Table:
        t = t.sort_by("piece")
        out = {c: t[c].to_numpy() for c in ("c", "piece")}
        for g, o in (("g1", "o1"), ("g2", "o2")):
            out[o] = (np.cumsum(t[g].to_numpy().astype(np.uint64)) & np.uint64(_MASK)).astype(np.int64)
        return pa.table(out)

    # what the pieces before it add to a piece, for conversations of more than one
    full = local.where(f"total >= {PIECE} AND d % {PIECE} = {PIECE - 1}").select("c", F.expr(f"d div {PIECE} + 1").alias("piece"), "g1", "g2")
    before = full.groupBy("c").applyInArrow(running, "c long, piece long, o1 long, o2 long")
    whole = local.withColumn("piece", F.expr(f"d div {PIECE}"))
    short, long = whole.where(f"total < {PIECE}"), whole.where(f"total >= {PIECE}").join(before, ["c", "piece"], "left")
    moved = [(F.col(x) + F.coalesce(o, F.lit(0))).bitwiseAND(F.lit(_MASK)).alias(x) for x, o in (("g1", "o1"), ("g2", "o2"), ("p1", "o1"), ("p2", "o2"))]
    kept = ["c", "total", "d", "t", "n"]
    return short.select(*kept, "g1", "g2", "p1", "p2").union(long.select(*kept, *moved))


class NodeTable:
    """A minimal perfect hash over distinct digests: number 0 .. n-1 each, -1 for a digest that is not there.

    Level by level, the digests left over are hashed into a bit array with room to spare;
    those alone in their place stay, the rest go on. A digest's number is the rank of its
    bit. The digest stored under a number is compared on every lookup.
    """

    def __init__(self, g1: np.ndarray, g2: np.ndarray):
        self.levels, placed, left = [], 0, np.arange(len(g1))
        number = np.empty(len(g1), np.int64)
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("a digest occurs twice in a shard")
            room = len(left) + len(left) // 2 + 1
            at = self._place(g1[left], g2[left], len(self.levels), room)
            alone = np.bincount(at, minlength=room) == 1
            rank = placed + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            stays = alone[at]
            number[left[stays]] = rank[at[stays]]
            placed, left = placed + int(alone.sum()), left[~stays]
        self.g1, self.g2 = np.empty_like(g1), np.empty_like(g2)
        self.g1[number], self.g2[number] = g1, g2
        self.number = number

    @staticmethod
    def _place(g1: np.ndarray, g2: np.ndarray, level: int, room: int) -> np.ndarray:
        seed = _mixed(np.array([2 * level + 1, 2 * level + 2], np.uint64))
        return ((_mixed(g1.astype(np.uint64) ^ seed[0]) + _mixed(g2.astype(np.uint64) ^ seed[1])) % np.uint64(room)).astype(np.int64)

    def find(self, g1: np.ndarray, g2: np.ndarray) -> np.ndarray:
        out, left = np.full(len(g1), -1), np.arange(len(g1))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._place(g1[left], g2[left], level, len(alone))
            here = alone[at]
            number, who = rank[at[here]], left[here]
            same = (self.g1[number] == g1[who]) & (self.g2[number] == g2[who])
            out[who[same]] = number[same]
            left = left[~here]
        return out


def accumulate(t: pa.Table, count: bool) -> dict[str, np.ndarray]:
    """Subtree sums of the nodes of a shard, in the order of ``t``.

    Columns: g1, g2, p1, p2, depth, own (leaves) and saved that hang below or at the node
    itself; with ``count`` the children are counted here and a childless node is a leaf.
    Gives children, leaves, saved and up (the row of the parent, -1 if it is not here).
    """
    c = {x: t[x].to_numpy() for x in ("g1", "g2", "p1", "p2", "depth", "leaves", "saved")}
    table = NodeTable(c["g1"], c["g2"])
    n, row = len(table.number), np.empty(len(table.number), np.int64)
    row[table.number] = np.arange(n)
    parent, leaves, saved, depth = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    parent[table.number] = np.where(c["depth"] > 0, table.find(c["p1"], c["p2"]), -1)
    leaves[table.number], saved[table.number], depth[table.number] = c["leaves"], c["saved"], c["depth"]
    children = np.bincount(parent[parent >= 0], minlength=n)
    if count:
        leaves += children == 0
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    up = np.where(parent >= 0, row[parent], -1)
    return {"children": children[table.number], "leaves": leaves[table.number], "saved": saved[table.number], "up": up[table.number]}


_NODE = "g1 long, g2 long, p1 long, p2 long, depth long, conv long, n_convs long, children long, leaves long, saved long, parent_conv long"


def _summed(nodes: DataFrame, key: list[str], count: bool) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        got = accumulate(t, count)
        kept = {c: t[c] for c in ("g1", "g2", "p1", "p2", "depth", "conv", "n_convs")}
        conv = t["conv"].to_numpy()
        kept["children"] = pa.array(got["children"]) if count else t["children"]
        kept |= {"leaves": pa.array(got["leaves"]), "saved": pa.array(got["saved"])}
        return pa.table(kept | {"parent_conv": pa.array(conv[got["up"]], mask=got["up"] < 0)})

    return nodes.groupBy(*key).applyInArrow(run, _NODE)


def trie_nodes(prefixes: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix, the empty one included, with checked parents and member counts."""
    zero = F.lit(0).cast("long")
    root = conversations.select("c", "total", zero.alias("d"), F.lit(b"").alias("t"), zero.alias("n"), *[zero.alias(x) for x in ("g1", "g2", "p1", "p2")])
    one = ("d", "t", "p1", "p2")
    grouped = prefixes.select(root.columns).union(root).groupBy("g1", "g2").agg(
        *[f(x).alias(f"{x}_{name}") for x in one for name, f in (("least", F.min), ("most", F.max))],
        F.min("c").alias("conv"),
        F.count("*").alias("n_convs"),
        F.min("n").alias("n"),
        F.sum(F.col("total") - F.col("d") + 1).alias("weight"),
    )
    sound = F.lit(True)
    for x in one:
        sound = sound & (F.col(f"{x}_least") == F.col(f"{x}_most"))
    depth = F.when(sound, F.col("d_least")).otherwise(F.raise_error(F.lit("two prefixes share a digest")).cast("long"))
    return grouped.select("g1", "g2", F.col("p1_least").alias("p1"), F.col("p2_least").alias("p2"), depth.alias("depth"), "conv", "n_convs", "n", "weight")


def prefix_trie(conversations: DataFrame, turns: DataFrame, unit: int = UNIT, band: int = BAND) -> DataFrame:
    """One row per node: conv (least member), depth, parent_conv, n_convs, children, leaves, saved, ends.

    ``ends`` is the SHA-256 of the ascending, comma-joined ids of the members that end there.
    """
    prefixes = materialise(prefix_digests(turns), "trie-paths")
    nodes = materialise(trie_nodes(prefixes, conversations), "trie-nodes")
    own = (F.col("n_convs") - 1) * F.col("n")
    plain = nodes.withColumn("saved", own).withColumn("leaves", F.lit(0).cast("long"))
    top = plain.where(F.col("weight") > unit).drop("weight", "n")
    heavy = top.count()
    low = plain.where(F.col("weight") <= unit).drop("weight", "n")
    if not heavy:
        done = _summed(low.withColumn("shard", F.lit(0)), ["shard"], True)
    else:
        near = F.broadcast if heavy <= BROADCAST_NODES else (lambda df: df)
        above = top.select(F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("conv").alias("above"))
        roots = low.join(near(above), ["p1", "p2"], "left_semi").select("g1", "g2", F.col("g1").alias("u1"), F.col("g2").alias("u2"))
        unit_of = prefixes.select("c", "g1", "g2").join(roots, ["g1", "g2"]).select(F.col("c").alias("conv"), "u1", "u2")
        shards = max(1, -(-nodes.count() // unit))
        low = low.join(unit_of, "conv").withColumn("shard", F.pmod(F.xxhash64("u1", "u2"), F.lit(shards)))
        low = materialise(_summed(low, ["shard"], True), "trie-units")
        hung = low.where("parent_conv IS NULL").groupBy("p1", "p2").agg(F.count("*").alias("k"), F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        hung = hung.union(top.where("depth > 0").groupBy("p1", "p2").agg(F.count("*"), F.lit(0).cast("long"), F.lit(0).cast("long")))
        hung = hung.groupBy(F.col("p1").alias("g1"), F.col("p2").alias("g2")).agg(*[F.sum(x).alias(x) for x in ("k", "l", "s")])
        kids = F.coalesce("k", F.lit(0))
        top = top.join(hung, ["g1", "g2"], "left").select(
            *[x for x in top.columns if x not in ("leaves", "saved")],
            kids.alias("children"),
            (F.coalesce("l", F.lit(0)) + (kids == 0).cast("long")).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
        )
        top = materialise(_banded(materialise(top, "trie-top"), prefixes, band) if heavy > unit else _summed(top.withColumn("shard", F.lit(0)), ["shard"], False), "trie-top")
        done = low.union(top)
        done = done.join(near(above), ["p1", "p2"], "left")
        done = done.withColumn("parent_conv", F.when(F.col("depth") > 0, F.coalesce("parent_conv", "above")))
    ends = end_digests(prefixes, conversations)
    return done.join(ends, ["g1", "g2"], "left").select(
        "conv", "depth", "parent_conv", "n_convs", "children", "leaves", "saved", F.coalesce("ends", F.lit(_EMPTY)).alias("ends")
    )


def _banded(top: DataFrame, prefixes: DataFrame, band: int) -> DataFrame:
    """Subtree sums of very many nodes: bands of depth, the trie of bands, then down into each band."""
    # the tops of the bands on each conversation's path; band 0 begins at the root
    marks = prefixes.where(F.col("d") % band == 0).select(F.col("c").alias("conv"), F.expr(f"d div {band}").alias("band"), F.col("g1").alias("u1"), F.col("g2").alias("u2"))
    zero = F.lit(0).cast("long")
    placed = top.withColumn("band", F.expr(f"depth div {band}")).join(marks, ["conv", "band"], "left")
    placed = materialise(placed.withColumn("u1", F.coalesce("u1", zero)).withColumn("u2", F.coalesce("u2", zero)), "trie-bands")
    totals = placed.groupBy("u1", "u2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    tops = placed.where("g1 = u1 AND g2 = u2").select("conv", "band", "g1", "g2", "p1", "p2", "n_convs", "children")
    upper = marks.select("conv", (F.col("band") + 1).alias("band"), F.col("u1").alias("q1"), F.col("u2").alias("q2"))
    small = tops.join(upper, ["conv", "band"], "left").join(totals.select(F.col("u1").alias("g1"), F.col("u2").alias("g2"), "leaves", "saved"), ["g1", "g2"])
    small = small.select("g1", "g2", F.coalesce("q1", zero).alias("p1"), F.coalesce("q2", zero).alias("p2"), F.col("band").alias("depth"), "conv", "n_convs", "children", "leaves", "saved", F.lit(0).alias("shard"))
    below = _summed(small, ["shard"], False).select("g1", "g2", F.col("leaves").alias("l"), F.col("saved").alias("s"))
    handed = tops.where("band > 0").join(below, ["g1", "g2"]).groupBy(F.col("p1").alias("g1"), F.col("p2").alias("g2")).agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    full = placed.join(handed, ["g1", "g2"], "left").withColumn("leaves", F.col("leaves") + F.coalesce("l", zero)).withColumn("saved", F.col("saved") + F.coalesce("s", zero))
    return _summed(full, ["u1", "u2"], False)


def end_digests(prefixes: DataFrame, conversations: DataFrame) -> DataFrame:
    """(g1, g2, ends): SHA-256 of the ids that end at a node, ascending and comma-joined.

    Ids are joined where their range of the sorted order lies; one task then reads the pieces
    of a node in order and keeps nothing but the hash.
    """
    zero = F.lit(0).cast("long")
    last = prefixes.where("d = total").select("g1", "g2", "c").union(conversations.where("total = 0").select(zero, zero, "c"))
    order = ["g1", "g2", "c"]
    last = materialise(last, "trie-ends")

    def runs(c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.flatnonzero((c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])) + 1, [len(c1)]])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                g1, g2, c = (x.to_numpy() for x in batch.columns)
                cut = runs(g1, g2)
                names = [",".join(map(str, c[a:b].tolist())).encode() for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(g1[cut[:-1]]), pa.array(g2[cut[:-1]]), pa.array(c[cut[:-1]]), pa.array(names, pa.binary())], names=[*order, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for g1, g2, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if (g1, g2) != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (g1, g2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py())
            if out:
                yield _ended(out)
        if node:
            yield _ended([(*node, state.hexdigest())])

    pieces = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "g1 long, g2 long, c long, ids binary")
    return pieces.repartition("g1", "g2").sortWithinPartitions(*order).mapInArrow(digest, "g1 long, g2 long, ends string")


def _ended(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["g1", "g2", "ends"])


def nodes(table: DataFrame, unit: int = UNIT, band: int = BAND) -> DataFrame:
    """The trie of the rebuilt conversations of ``table``, one row per node."""
    conversations, turns = rebuilt(table)
    return prefix_trie(conversations, turns, unit, band).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
