"""Suffix-array dedup (operator 6): removal of every repeated 400-byte string.

One suffix array over a corpus fits no task, so the suffixes are dealt out by content
first. Each 400-byte window is owned by an anchor inside it, the 200-byte string of least
hash (the last such): equal windows have equal anchors at equal offsets. Anchors seen once
own no repeated window. The stretches of text that the other anchors own are gathered by
anchor, equal stretches once with their number, and are sorted by two-stage suffix
sorting: suffixes smaller than their successors are sorted directly, the rest is induced
by bucket scans, and adjacent common prefixes of 400 bytes are repeats.

An anchor with more than ``group_rows`` different stretches (a passage that very many
documents share, each in its own surroundings) is split before: its windows differ in how
much they hold to the left of the anchor, so that a range of these lengths has more text in
common than the anchor. Stretches are cut to each of a few ranges and dealt by anchor, range
and common text; equal cuts become one with their number, cuts alone in their group own no
repeat, and groups that are still too large are split again, down to single windows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import WORDS, as_bytes, col, map_docs, materialise, parts, small_batches, unpack
from loomfeat.llm.jaccard import CHUNK, _Powers, mixed, with_ids

# ---------------------------------------------------------------- anchors


def _least_in_windows(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values: block minima from both sides."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def anchors(texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """(document, anchor hash, first and last owned start, digest of the owned bytes, the anchor's place behind the first).

    Starts are relative to their document; a text shorter than a window has none.
    """
    stream = b" ".join(texts)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    length = np.array([len(t) for t in texts], np.int64)
    gram = window // 2
    if len(stream) < window:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    data = np.frombuffer(stream, np.uint8)
    up, down = _Powers.get(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    h = mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    at = np.arange(len(h), dtype=np.uint64)
    low = np.uint64(0xFFFFFFFF)
    owner = (low - (_least_in_windows((h & ~low) | (low - at), window - gram + 1) & low)).astype(np.int64)
    starts = np.flatnonzero(_inside(len(owner), begin, length, window))
    own = owner[starts]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    first = starts[new]
    last = np.append(starts[np.flatnonzero(new)[1:] - 1], starts[-1:])
    digest = np.array([xxhash.xxh3_64_intdigest(stream[a : b + window]) for a, b in zip(first.tolist(), last.tolist())], np.uint64).view(np.int64)
    doc = np.searchsorted(begin, first, side="right") - 1
    return doc, h[own[new]].view(np.int64), first - begin[doc], last - begin[doc], digest, own[new] - first


def _inside(n: int, begin: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """Starts whose window lies within one document."""
    edge = np.zeros(n + 1, np.int32)
    long = length >= window
    np.add.at(edge, begin[long], 1)
    np.add.at(edge, (begin + length - window + 1)[long], -1)
    return np.cumsum(edge[:-1]) > 0


# ---------------------------------------------------------------- two-stage suffix sorting


def two_stage(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of bytes (0: separator, also at the end), in order to ``depth`` bytes at least."""
    n = len(text)
    t = text.astype(np.int16)
    step = np.append(t[1:], -1) - t
    turn = np.flatnonzero(step)
    smaller = step[turn[np.searchsorted(turn, np.arange(n))]] > 0  # than its successor
    string = text.tobytes().decode("latin-1")
    direct = np.flatnonzero(smaller)
    direct = direct[np.argsort(text[direct], kind="stable")]
    buckets = np.split(direct, np.flatnonzero(np.diff(text[direct])) + 1)  # only one bucket's keys at a time
    direct = np.concatenate([np.array(sorted(b.tolist(), key=lambda i: string[i : i + depth]), np.int64) for b in buckets])
    count = np.bincount(text, minlength=256)
    head = np.cumsum(count) - count
    tail = head + np.bincount(text[~smaller], minlength=256)  # where the directly sorted begin
    sa = np.empty(n, np.int64)
    kinds = text[direct]
    sa[tail[kinds] + np.arange(n)[: len(direct)] - np.searchsorted(kinds, kinds)] = direct
    fill = head.copy()
    sa[fill[text[-1]]] = n - 1  # the last suffix, whose successor is empty
    fill[text[-1]] += 1

    def induce(members: np.ndarray) -> None:
        before = members[members > 0] - 1
        before = before[~smaller[before]]
        c = text[before]
        order = np.argsort(c, kind="stable")
        before, c = before[order], c[order]
        sa[fill[c] + np.arange(len(c)) - np.searchsorted(c, c)] = before
        fill[:] += np.bincount(c, minlength=256)

    for c in np.flatnonzero(count):
        done = head[c]
        while done < fill[c]:  # equal bytes induce into their own bucket
            until = fill[c]
            induce(sa[done:until])
            done = until
        induce(sa[tail[c] : head[c] + count[c]])
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the array, up to ``depth``."""
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(words).view("<u8").ravel()
    out = np.zeros(len(sa), np.int64)
    live, a, b = np.arange(1, len(sa)), sa[:-1], sa[1:]
    for d in range(0, depth, 8):
        differ = words[a + d] ^ words[b + d]
        same = differ == 0
        if not same.all():
            x = differ[~same]
            out[live[~same]] = d + np.log2((x & (~x + np.uint64(1))).astype(np.float64)).astype(np.int64) // 8
            live, a, b = live[same], a[same], b[same]
    out[live] = depth
    return out


def repeated_starts(stretches: list[bytes], window: int) -> list[np.ndarray]:
    """For each stretch, the flags of its window starts that occur again among all."""
    text = np.frombuffer(b"\x00".join(stretches) + b"\x00", np.uint8).copy()
    begin = np.cumsum([0] + [len(s) + 1 for s in stretches])
    # UTF-8 has no byte above 0xF4, so bytes move up by one and 0 separates
    inner = np.ones(len(text), bool)
    inner[begin[1:] - 1] = False
    text[inner] += 1
    text[~inner] = 0
    sa = two_stage(text, window)
    again = np.flatnonzero(common_prefixes(text, sa, window) >= window)
    flags = np.zeros(len(text), bool)
    flags[sa[again]] = True
    flags[sa[again - 1]] = True
    return [flags[a : a + len(s) - window + 1] for a, s in zip(begin.tolist(), stretches)]


def flag_runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of the runs of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


# ---------------------------------------------------------------- Spark side

_KEY = ["id", "k"]
_OWNED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("k", T.LongType()),
        T.StructField("anchor", T.LongType()),
        T.StructField("first", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("span", T.LongType()),
        T.StructField("place", T.IntegerType()),
    ]
)
_MARK = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])


def _arrow_type(t: T.DataType) -> pa.DataType:
    return {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BinaryType(): pa.binary()}[t]


def _batch(schema: T.StructType, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _arrow_type(f.dataType)) for c, f in zip(columns, schema.fields)], names=schema.names)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with a key that tells different ones apart; rows alike in it have equal marks."""
    return docs.select(F.coalesce(col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(col(text_col)).alias("k"), col(text_col).cast("binary").alias("t"))


def _owned(texts: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, data = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_pylist()
            at = 0
            while at < len(data):
                until, size = at, 0
                while until < len(data) and size < CHUNK:
                    size += len(data[until]) + 1
                    until += 1
                doc, *rest = anchors(data[at:until], window)
                yield _batch(_OWNED, [ids[at:until][doc], keys[at:until][doc], rest[0], rest[1].astype(np.int32), rest[2].astype(np.int32), rest[3], rest[4].astype(np.int32)])
                at = until

    return texts.where(F.octet_length("t") >= window).select("id", "k", "t").mapInArrow(run, _OWNED)


def _stretches(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The bytes of one stretch of each kind, cut from the document that represents it."""
    ids = materialise(wanted.select("id").distinct(), "stretch-ids")
    pieces = wanted.groupBy("id", "k").agg(F.collect_list(F.struct("anchor", "first", "last", "place", "number", "hot")).alias("parts"))
    joined = with_ids(texts, ids, "left_semi").dropDuplicates(_KEY).join(pieces, _KEY)
    rows = joined.select("id", "k", "t", F.explode("parts").alias("p"))
    cut = F.expr(f"substring(t, p.first + 1, p.last - p.first + {window})")
    return rows.select("id", "k", "p.anchor", "p.first", "p.place", "p.number", "p.hot", cut.alias("bytes"))


def _sorted_marks(stretches: DataFrame, window: int, batch_bytes: int) -> DataFrame:
    """Marks of single stretches that repeat others of their anchor in part."""

    def marks(held: list[tuple]) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        for row, flags in zip(held, repeated_starts([r[4] for r in held], window)):
            if row[3] == 1:
                for a, b in flag_runs(flags):
                    for c, v in zip(out, (row[0], row[1], row[2] + a, row[2] + b)):
                        c.append(v)
        return _batch(_MARK, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, anchor = [], 0, None
        for b in (part for batch in batches for part in parts(batch)):
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("anchor", "id", "k", "first", "number", "bytes")]
            for a, *row in zip(*cols):
                if a != anchor and size >= batch_bytes:
                    yield marks(held)
                    held, size = [], 0
                anchor = a
                held.append(tuple(row))
                size += len(row[4])
        if held:
            yield marks(held)

    dealt = stretches.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.select("id", "k", "anchor", "first", "number", "bytes").mapInArrow(run, _MARK)


def _cuts(pieces: DataFrame, window: int, width: int, step: int) -> DataFrame:
    """The pieces of ranges ``width`` long, cut to each of their ranges of ``step`` lengths.

    A piece owns the windows with ``low`` to ``low + width - 1`` bytes before the anchor, as far
    as its document has them; its anchor begins ``place`` bytes behind its first byte.
    """
    lows = F.explode(F.sequence("low", F.col("low") + (width - 1), F.lit(step))).alias("lo")
    ranges = pieces.select("id", "k", "anchor", "number", "first", "place", "bytes", lows, (F.col("low") + (width - 1)).alias("end"))
    ranges = ranges.withColumn("hi", F.least(F.col("lo") + (step - 1), "end"))
    least = F.greatest("lo", F.col("place") - (F.octet_length("bytes") - window))
    held = ranges.select("*", least.alias("least"), F.least("hi", "place").alias("most")).where("least <= most")
    text = F.expr(f"substring(bytes, place - most + 1, most - least + {window})")
    cut = held.select("id", "k", "anchor", "number", "lo", "hi", F.expr("first + place - most").alias("first"), F.col("most").alias("place"), text.alias("bytes"))
    common = F.expr(f"substring(bytes, place - lo + 1, {window} + lo - hi)")
    return cut.select("id", "k", "anchor", F.col("lo").alias("low"), "first", "place", "number", "bytes", F.xxhash64("anchor", "lo", common).alias("group"))


def _split_marks(pieces: DataFrame, window: int, group_rows: int, batch_bytes: int, ranges: int = 4) -> DataFrame:
    """Marks of single stretches whose anchors have too many to gather: by common text in ranges of windows."""
    out: list[DataFrame] = []
    width = window - window // 2 + 1  # lengths of text that a window may hold before its anchor
    pieces = pieces.withColumn("low", F.lit(0))
    while width > 1:
        step = -(-width // ranges)
        cuts = materialise(_cuts(pieces, window, width, step), "cuts")
        kinds = cuts.groupBy("group", "anchor", "low", "place", "bytes").agg(F.sum("number").alias("all"), F.min(F.struct("id", "k", "first")).alias("one"))
        kinds = materialise(kinds.select("group", "anchor", "low", "place", "bytes", F.col("all").alias("number"), "one.*"), "cut-kinds")
        alike = kinds.where("number > 1").select("group", "place", "bytes")
        whole = cuts.where("number = 1").join(alike, ["group", "place", "bytes"], "left_semi")
        out.append(whole.select("id", "k", "first", F.expr(f"first + octet_length(bytes) - {window}").cast("int").alias("last")))
        if step == 1:  # a group is one window
            break
        groups = kinds.groupBy("group").agg(F.count("*").alias("kinds"), F.min("number").alias("least")).where("kinds > 1 and least = 1")
        mixed_groups = materialise(kinds.join(groups.select("group", "kinds"), "group"), "mixed-groups")
        gathered = mixed_groups.where(F.col("kinds") <= group_rows)
        out.append(_sorted_marks(gathered.drop("anchor").withColumnRenamed("group", "anchor"), window, batch_bytes))
        pieces, width = mixed_groups.where(F.col("kinds") > group_rows), step
        if pieces.isEmpty():
            break
    return functools.reduce(DataFrame.union, out)


def repeats(texts: DataFrame, window: int = 400, group_rows: int = 400, batch_bytes: int = 128 << 10) -> DataFrame:
    """(id, k, spans): the byte ranges, unmerged, that repeated windows of a text cover."""
    small_batches(texts.sparkSession)
    owned = materialise(_owned(texts, window), "anchors")
    # written first, so that the join below has plain exchanges on both sides and splits hot anchors
    again = materialise(owned.groupBy("anchor").count().where("count > 1").select("anchor"), "again")
    owned = materialise(owned.join(again, "anchor"), "repeated-anchors").select(*_OWNED.names)
    kinds = materialise(
        owned.groupBy("anchor", "span").agg(F.count("*").alias("number"), F.min(F.struct("id", "k", "first", "last", "place")).alias("one")).select("anchor", "span", "number", "one.*"), "stretches"
    )
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("number").alias("least")).where("kinds > 1 and least = 1")
    wanted = materialise(kinds.join(groups.select("anchor", (F.col("kinds") > group_rows).alias("hot")), "anchor"), "wanted")
    cut = materialise(_stretches(texts, wanted, window), "cut")
    whole = owned.join(kinds.where("number > 1").select("anchor", "span"), ["anchor", "span"], "left_semi").select(*_MARK.names)
    marks = whole.union(_sorted_marks(cut.where("not hot"), window, batch_bytes))
    hot = cut.where("hot")
    if not hot.isEmpty():
        marks = marks.union(_split_marks(hot, window, group_rows, batch_bytes))
    return marks.groupBy(*_KEY).agg(F.collect_list(F.struct("first", "last")).alias("starts"))


def merged(starts: list[dict], window: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by the windows at the given ranges of starts."""
    out: list[list[int]] = []
    for a, b in sorted((s["first"], s["last"] + window) for s in starts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def gapless(starts: list[dict]) -> list[list[int]]:
    """First and last start of the runs without a gap."""
    runs: list[list[int]] = []
    for a, b in sorted((s["first"], s["last"]) for s in starts):
        if runs and a <= runs[-1][1] + 1:
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    return runs


def passages(text: bytes, starts: list[dict], window: int, min_words: int, min_bytes: int) -> list[tuple[int, int]]:
    """Maximal byte runs as by ``merged``, of the passages that are long enough.

    A passage is what a gapless run of starts covers: of a string that repeats as a whole,
    every start is marked. So two short repeats side by side are two passages. One goes if it
    holds ``min_words`` whole words, or ``min_bytes`` bytes (scripts without blanks).
    """
    long = [{"first": a, "last": b} for a, b in gapless(starts) if b + window - a >= min_bytes or whole_words(text, a, b + window) >= min_words]
    return merged(long, window)


def whole_words(text: bytes, a: int, b: int) -> int:
    """Blank-separated words of ``text[a:b]``; one that the range cuts in its letters or digits is none."""
    found = text[a:b].split()
    glued = lambda i: 0 < i < len(text) and not text[i - 1 : i + 1].translate(WORDS).count(b" ")
    return max(0, len(found) - glued(a) - glued(b))


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


_REGION = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("t", T.BinaryType())])


def _repeats_within(texts: DataFrame, marks: DataFrame, short: int, window: int) -> DataFrame:
    """``repeats`` for ``window`` bytes, searched where strings of ``short`` bytes repeat.

    All short strings of a longer one that repeats do so too: it lies in a gapless run of
    their starts, and so do its other occurrences. Each run is a text of its own here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in parts(batch)):
            out: list[list] = [[], [], [], []]
            for id_, k, text, starts in zip(*[c.to_pylist() for c in b.columns]):
                for a, z in gapless(starts):
                    if z + short - a >= window:
                        for c, v in zip(out, (id_, k, a, text[a : z + short])):
                            c.append(v)
            yield _batch(_REGION, out)

    ids = materialise(marks.select("id").distinct(), "region-ids")
    rows = with_ids(texts, ids, "left_semi").join(marks, _KEY).select("id", "k", "t", "starts")
    regions = materialise(rows.mapInArrow(run, _REGION).withColumn("rk", F.xxhash64("k", "at")), "regions")
    found = materialise(repeats(regions.select("id", F.col("rk").alias("k"), "t"), window), "region-repeats").withColumnRenamed("k", "rk")
    back = regions.select("id", "rk", "k", "at").distinct().join(found, ["id", "rk"])
    moved = F.transform("starts", lambda s: F.struct((s["first"] + F.col("at")).alias("first"), (s["last"] + F.col("at")).alias("last")))
    return back.groupBy(*_KEY).agg(F.flatten(F.collect_list(moved)).alias("longer"))


def _marked(docs: DataFrame, keep: list[str], id_col: str, text_col: str, window: int, longer: int = 0) -> tuple[DataFrame, DataFrame]:
    """The rows without repeats, and the others with the starts of their repeats.

    Both carry ``keep`` in ``doc`` and the text as ``t``. With ``longer``, the others also
    have the starts of repeats of that many bytes.
    """
    texts = _keyed(docs, id_col, text_col)
    marks = materialise(repeats(texts, window), "repeats")
    if longer:
        marks = materialise(marks.join(_repeats_within(texts, marks, window, longer), _KEY, "left"), "longer-repeats")
    # the columns travel in a struct: their names cannot clash with the key's
    packed = docs.select(F.struct(*[col(c) for c in keep]).alias("doc"), F.coalesce(col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(col(text_col)).alias("k"), col(text_col).alias("t"))
    ids = materialise(marks.select("id").distinct(), "repeat-ids")
    few = with_ids(packed, ids, "left_semi").join(marks, _KEY, "left")
    return with_ids(packed, ids, "left_anti").select("doc", "t"), few.select("doc", "t", *[c for c in marks.columns if c not in _KEY])


def removed_spans(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", window: int = 400, min_words: int = 0) -> DataFrame:
    """The kept columns in ``doc``; n_bytes, n_removed, n_spans, kept_sha256, spans (byte ranges).

    A byte goes if it lies in a ``window``-byte string that also starts anywhere else in
    the input, the same document included; strings are judged on the input. A null text is
    an empty one; repeated rows are documents that repeat each other; an empty table gives
    no rows.

    With ``min_words``, also n_passages, n_passage_bytes and passages (byte ranges): the
    maximal runs of repeats of that many words or ``window`` bytes (see ``passages``). They
    need a search for shorter strings, within whose repeats the windows are then searched.
    """
    short = min(window, 2 * min_words - 1) if min_words else window
    clean, marked = _marked(docs, keep, id_col, text_col, short, window if min_words else 0)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [*[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept_sha256", T.StringType()), T.StructField("spans", span)]
    if min_words:
        fields += [T.StructField("n_passages", T.LongType()), T.StructField("n_passage_bytes", T.LongType()), T.StructField("passages", span)]
    data = F.coalesce(F.col("t").cast("binary"), F.lit("").cast("binary"))
    own = {"n_bytes": F.octet_length(data).cast("long"), "kept_sha256": F.sha2(data, 256)}
    none = {T.LongType(): F.lit(0).cast("long"), span: F.array().cast(span)}
    plain = clean.select("doc", *[(own[f.name] if f.name in own else none[f.dataType]).alias(f.name) for f in fields])

    def ranges(found: list[list[tuple[int, int]]]) -> list[pa.Array]:
        numbers = [pa.array(x, pa.int64()) for x in ([sum(b - a for a, b in s) for s in found], [len(s) for s in found])]
        return [*numbers, pa.array([[{"start": a, "end": b} for a, b in s] for s in found], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]

    def run(batches):
        for texts, *starts in batches:
            texts = [t or b"" for t in as_bytes(texts)]
            spans = [merged(s or [], window) for s in starts[-1].to_pylist()]
            removed, count, where = ranges(spans)
            hashes = pa.array([hashlib.sha256(kept_bytes(t, s)).hexdigest() for t, s in zip(texts, spans)], pa.string())
            out = [pa.array([len(t) for t in texts], pa.int64()), removed, count, hashes, where]
            if min_words:
                gone, number, places = ranges([passages(t, s or [], short, min_words, window) for t, s in zip(texts, starts[0].to_pylist())])
                out += [number, gone, places]
            yield out

    cut = map_docs(marked, ["doc"], {"t": F.col("t"), **{c: F.col(c) for c in marked.columns if c not in ("doc", "t")}}, run, fields)
    return plain.union(cut.select(F.col("doc.doc").alias("doc"), *[f.name for f in fields]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 400, min_words: int = 0, min_bytes: int = 400) -> DataFrame:
    """The documents (same columns) without the repeated bytes.

    With ``min_words``, only of repeats of that many words or ``min_bytes`` bytes (``passages``);
    ``window`` bounds from below what is found, and n words take 2n - 1 bytes at least.

    A character cut in part goes whole. Documents without repeats pass unchanged; one of
    which only white space is left goes.
    """
    names = docs.columns
    clean, marked = _marked(docs, names, id_col, text_col, window)

    def spans(text: bytes, starts: list[dict]) -> list[tuple[int, int]]:
        return passages(text, starts, window, min_words, min_bytes) if min_words else merged(starts, window)

    def run(batches):
        for texts, starts in batches:
            yield [pa.array([t if t is None or not s else kept_bytes(t, spans(t, s)).decode("utf-8", "ignore").encode() for t, s in zip(as_bytes(texts), starts.to_pylist())], pa.binary()).cast(pa.string())]

    cut = map_docs(marked, ["doc", "starts"], {"t": F.col("t"), "s": F.col("starts")}, run, [T.StructField("left", T.StringType())])
    cut = cut.where(F.col("doc.starts").isNull() | (F.length(F.regexp_replace("left", r"\s+", "")) > 0))
    same = clean.select(*unpack(clean, names))
    return same.union(cut.select(*[F.col("left").alias(c) if c == text_col else F.col("doc.doc").getField(c).alias(c) for c in names]))


def digests(docs: DataFrame) -> DataFrame:
    """The digest rows of ``op6_suffix_dedup``."""
    out = removed_spans(docs, ["doc_id"])
    return out.select(*unpack(out, ["doc_id"]), "n_bytes", "n_removed", "n_spans", "kept_sha256")
