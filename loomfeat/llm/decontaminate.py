"""Benchmark decontamination (operator 3): an FM-index per training shard.

A shard is a run of whole documents of one Spark partition, closed at ``shard_bytes`` of
text. Its words become ids of the benchmark vocabulary; a word outside it can be part of
no benchmark phrase, so it is a separator, and runs shorter than the shortest phrase are
left out of the index. The shard's suffix array gives the Burrows-Wheeler transform, kept
as a wavelet matrix; all phrases are searched backward at once by its ranks, occurrences
are located by walking to the next sampled suffix position, and overlapping occurrences
are merged into removal spans. Nothing is shuffled: only benchmark phrases travel, in
slices of at most about ``slice_bytes`` of benchmark text, one pass over the documents each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import WORDS, as_bytes, col, map_docs, unpack

SAMPLE_EVERY = 8


# ---------------------------------------------------------------- suffix array and FM-index


def suffix_array(seq: np.ndarray, bits: int) -> np.ndarray:
    """Suffix order of ``seq``, whose zeros are separators that rank by position.

    The first key packs as many symbols as a word holds; ties are refined by doubling.
    Suffixes equal up to a separator stay in text order, as distinct separators would order them.
    """
    n = len(seq)
    width = 62 // bits
    key = np.zeros(n, np.int64)
    alive = np.ones(n, bool)
    for d in range(width):
        sym = np.zeros(n, np.int64)
        sym[: max(0, n - d)] = seq[d:]
        key = (key << bits) | np.where(alive, sym, 0)
        alive &= sym != 0
    sa = np.argsort(key, kind="stable")
    ranks = np.empty(n, np.int64)

    def regroup(slots, keys, members):
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        start = np.flatnonzero(first)
        ranks[members] = slots[start][np.cumsum(first) - 1]
        size = np.diff(np.append(start, len(keys)))
        return np.repeat(size > 1, size)

    open_ = regroup(np.arange(n), key[sa], sa)
    slots, members, k = np.flatnonzero(open_), sa[open_], width
    keep = alive[members]  # a suffix that met its separator within k symbols is settled
    slots, members = slots[keep], members[keep]
    ends = np.flatnonzero(seq == 0)
    while len(members):
        nxt = np.where(members + k < n, ranks[np.minimum(members + k, n - 1)], 0)
        keys = ranks[members] * np.int64(n + 1) + nxt
        order = np.argsort(keys, kind="stable")
        members, keys = members[order], keys[order]
        sa[slots] = members
        open_ = regroup(slots, keys, members)
        k *= 2
        stop = np.searchsorted(ends, members)
        reach = np.where(stop < len(ends), ends[np.minimum(stop, max(0, len(ends) - 1))] if len(ends) else n, n)
        keep = open_ & (members + k <= reach)
        slots, members = slots[keep], members[keep]
    return sa


class FMIndex:
    """Backward search and location over a sequence of ids 1..size with 0 as separator."""

    def __init__(self, seq: np.ndarray, size: int):
        self.bits = max(1, int(size).bit_length())
        sa = suffix_array(seq, self.bits)
        n = len(seq)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=size + 1))])
        bwt = np.where(sa > 0, seq[sa - 1], 0)
        sampled = (sa % SAMPLE_EVERY == 0) | (bwt == 0)
        self.sampled, self.sample_at, self.samples = sampled, np.cumsum(sampled) - 1, sa[sampled]
        self.zeros, self.counts = [], []
        for level in reversed(range(self.bits)):
            bit = (bwt >> level) & 1
            c = np.zeros(n + 1, np.int32)
            np.cumsum(1 - bit, out=c[1:])
            self.counts.append(c)
            self.zeros.append(int(c[-1]))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])

    def rank(self, symbols: np.ndarray, *rows: np.ndarray) -> list[np.ndarray]:
        """Occurrences of each symbol before each row of the transform."""
        at = [np.zeros(len(symbols), np.int64), *[r.astype(np.int64) for r in rows]]
        for i, level in enumerate(reversed(range(self.bits))):
            one = ((symbols >> level) & 1).astype(bool)
            c, z = self.counts[i], self.zeros[i]
            at = [np.where(one, z + r - c[r], c[r]) for r in at]
        return [r - at[0] for r in at[1:]]

    def symbol(self, rows: np.ndarray) -> np.ndarray:
        out, r = np.zeros(len(rows), np.int64), rows.astype(np.int64)
        for i in range(self.bits):
            c, z = self.counts[i], self.zeros[i]
            one = c[r + 1] == c[r]
            out = (out << 1) | one
            r = np.where(one, z + r - c[r], c[r])
        return out

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of right-aligned phrases (rows of ids, zeros in front)."""
        last = phrases[:, -1]
        lo, hi = self.before[last].copy(), self.before[last + 1].copy()
        for j in range(phrases.shape[1] - 2, -1, -1):
            on = np.flatnonzero((phrases[:, j] > 0) & (hi > lo))
            if not len(on):
                continue
            c = phrases[on, j]
            a, b = self.rank(c, lo[on], hi[on])
            lo[on], hi[on] = self.before[c] + a, self.before[c] + b
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps, out = rows.copy(), 0, np.empty(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            r = rows[todo]
            done = self.sampled[r]
            out[todo[done]] = self.samples[self.sample_at[r[done]]] + steps
            todo = todo[~done]
            r = rows[todo]
            c = self.symbol(r)
            rows[todo] = self.before[c] + self.rank(c, r)[0]
            steps += 1
        return out


# ---------------------------------------------------------------- phrases


class Phrases:
    """Distinct windows of the benchmark items of one slice."""

    def __init__(self, items: list[tuple[str, bytes | None]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in (text or b"").translate(WORDS).split()]
            for i in range(max(1, len(ids) - n + 1) if ids else 0):
                windows.setdefault(tuple(ids[i : i + n]), set()).add(item)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.items = [sorted(x) for x in windows.values()]
        width = max(self.lengths, default=1)
        self.matrix = np.zeros((len(windows), width), np.int64)
        for i, w in enumerate(windows):
            self.matrix[i, width - len(w) :] = w
        self.shortest = int(self.lengths.min()) if len(windows) else 0


def shard_hits(docs: list[bytes | None], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, dict[int, set[str]]]:
    """(word offsets of the documents, hit flag of every word, items by document) of a shard."""
    get = phrases.vocabulary.get
    ids, bounds = [], [0]
    for text in docs:
        words = text.translate(WORDS).split() if text else ()
        ids.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
        bounds.append(bounds[-1] + len(words))
    bounds = np.array(bounds)
    words = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    hit, items = np.zeros(len(words), bool), {}
    if not len(words) or not len(phrases.matrix):
        return bounds, hit, items
    known = words > 0
    first = known.copy()
    first[1:] &= ~known[:-1]
    inner = bounds[1:-1][bounds[1:-1] < len(words)]
    first[inner] |= known[inner]
    starts = np.flatnonzero(first)
    stop = np.flatnonzero(~known)
    ends = np.append(stop, len(words))[np.searchsorted(stop, starts)] if len(stop) else np.full(len(starts), len(words))
    ends = np.minimum(ends, np.append(starts[1:], len(words)))
    long = ends - starts >= phrases.shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return bounds, hit, items
    size = ends - starts + 1  # one separator behind each run
    begin = np.cumsum(size) - size
    origin = np.arange(size.sum()) - np.repeat(begin - starts, size)
    seq = np.zeros(len(origin), np.int64)
    inside = np.ones(len(origin), bool)
    inside[begin + size - 1] = False
    seq[inside] = words[origin[inside]]

    index = FMIndex(seq, len(phrases.vocabulary))
    lo, hi = index.search(phrases.matrix)
    found = np.flatnonzero(hi > lo)
    count = (hi - lo)[found]
    rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo[found], count)
    at, which = origin[index.locate(rows)], np.repeat(found, count)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + phrases.lengths[which], -1)
    hit = np.cumsum(edge[:-1]) > 0
    doc = np.searchsorted(bounds, at, side="right") - 1
    for d, w in np.unique(np.stack([doc, which], 1), axis=0).tolist():
        items.setdefault(d, set()).update(phrases.items[w])
    return bounds, hit, items


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def byte_spans(text: bytes, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of word ranges, from the first word's first byte to the last word's last."""
    a, b = runs(np.frombuffer(text.translate(WORDS), np.uint8) != 0x20)
    return list(zip(a[starts].tolist(), b[ends - 1].tolist()))


# ---------------------------------------------------------------- operator

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(SPAN)),
]
_ARROW = [
    pa.int64(), pa.int64(), pa.list_(pa.string()),
    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
]


def _search(phrases, shard_bytes: int):
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[list]:
        held: list[tuple[int, list]] = []

        def flush():
            docs = [d for _, rows in held for d in rows[0]]
            bounds, hit, items = shard_hits(docs, phrases.value)
            out = ([], [], [], [])
            for i, text in enumerate(docs):
                flags = hit[bounds[i] : bounds[i + 1]]
                before = [c[i] for c in earlier()]
                spans = byte_spans(text, *runs(flags)) if flags.any() else []
                names = items.get(i, set())
                if before and before[1]:
                    flags, spans, names = merge(text, flags, before[1]) + (names | set(before[0]),)
                out[0].append(len(flags))
                out[1].append(int(flags.sum()))
                out[2].append(sorted(names))
                out[3].append([{"start": a, "end": b} for a, b in spans])
            begin = 0
            for n, _ in held:
                yield [pa.array(c[begin : begin + n], t) for c, t in zip(out, _ARROW)]
                begin += n
            held.clear()

        def earlier():
            return [[x for _, rows in held for x in rows[k]] for k in (1, 2)] if held and len(held[0][1]) > 1 else []

        size = 0
        for arrays in batches:
            rows = [as_bytes(arrays[0]), *[a.to_pylist() for a in arrays[1:]]]
            held.append((len(rows[0]), rows))
            size += sum(len(x) for x in rows[0] if x)
            if size >= shard_bytes:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return run


def merge(text: bytes, flags: np.ndarray, spans: list[dict]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Hits of this slice joined with the byte spans of earlier ones."""
    a, _ = runs(np.frombuffer(text.translate(WORDS), np.uint8) != 0x20)
    flags = flags.copy()
    for s in spans:
        flags[np.searchsorted(a, s["start"]) : np.searchsorted(a, s["end"])] = True
    return flags, byte_spans(text, *runs(flags))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 10,
    shard_bytes: int = 8 << 20,
    slice_bytes: int = 16 << 20,
) -> DataFrame:
    """Per document: the kept columns in ``doc``, n_words, n_hit, items, spans (byte ranges).

    An item's windows are its runs of ``n`` words (all its words if fewer; none if it has
    none). ``items`` are the ids, as strings, of items with an occurring window, ``spans``
    the merged byte ranges of hit words. A null or empty text has no words; a null item id
    reads ``null``; repeated rows are judged alike, and an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    texts = benchmark.select(col(item_col).cast("string").alias("i"), col(item_text_col).cast("binary").alias("t"))
    total = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_slices = max(1, math.ceil(total / slice_bytes))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(n_slices))
    out, names = docs, sorted({*keep, text_col})
    for k in range(n_slices):
        rows = texts.where(part == k).collect()
        phrases = spark.sparkContext.broadcast(Phrases([("null" if r.i is None else r.i, r.t and bytes(r.t)) for r in rows], n))
        last = k == n_slices - 1
        if k == 0:
            inputs = {"_text": text_col}
            out = map_docs(out, keep if last else names, inputs, _search(phrases, shard_bytes), FIELDS)
        else:
            inputs = {"_text": F.col("_t"), "_items": F.col("_i"), "_spans": F.col("_s")}
            carried = out.select(*unpack(out, names), F.col("doc").getField(text_col).alias("_t"), F.col("items").alias("_i"), F.col("spans").alias("_s"))
            out = map_docs(carried, keep if last else names, inputs, _search(phrases, shard_bytes), FIELDS)
    return out


def cut_spans(text: bytes, spans: list[dict]) -> bytes:
    """The text without its spans; the pieces around a span are joined by a line break."""
    out, at = [], 0
    for s in spans:
        out.append(text[at : s["start"]])
        at = s["end"]
    return b"\n".join([*out, text[at:]])


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents (same columns) with every contaminated span cut out of the text.

    Clean documents pass unchanged; a document of which no word is left goes.
    """
    names = docs.columns
    found = find_contamination(docs, benchmark, names, text_col, **options)

    def cut(batches):
        for texts, spans in batches:
            yield [pa.array([cut_spans(t, s) if s else t for t, s in zip(as_bytes(texts), spans.to_pylist())], pa.binary()).cast(pa.string())]

    hit = F.col("n_hit") > 0
    left = found.where(~hit | (F.col("n_hit") < F.col("n_words")))
    cleaned = map_docs(left.select(*unpack(left, names), F.col("spans").alias("_spans")), names, {"t": text_col, "s": F.col("_spans")}, cut, [T.StructField("_clean", T.StringType())])
    return cleaned.select(*[F.col("_clean").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in names])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest rows of ``op3_decontaminate``."""
    out = find_contamination(docs, benchmark, ["doc_id"])
    return out.select(
        *unpack(out, ["doc_id"]),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
