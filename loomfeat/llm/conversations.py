"""Chat formatting (operator 1): quotation linking, with DataFrame functions only.

Lines that begin with ``>`` marks are quotes, as deep as they have marks. Consecutive
lines of one depth are a passage; it is normalised (lower case, letters and digits, single
blanks), hashed, and joined to the messages of its conversation by the hashes of their own
text: the whole, its paragraphs, its lines. A passage none of them equals is linked by its
longest paragraph or line that one equals; empty quoted lines part its paragraphs. The
original is the first message that holds the text.

The result has every message without its quotes, the message it answers, and is sorted by
conversation, answered message and turn: each message follows the one it answers, and
answers to one message stand together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeat.llm.common import col, materialise

QUOTED = r"^\s*>"
ANY_QUOTE = r"(?m)^[ \t]*>"
_WROTE = r"(?i:wrote|writes|schrieb|a écrit|escribió|escreveu|ha scritto|schreef|написала?|пишет|写道)"
_NOBODY = r"(?<!\b(?i:I|you|he|she|we|they|it|who)\s)"
#: A line that tells who wrote what is quoted below it ends in a colon; it has a date or an address, or a name only.
COLON = r"[:：]\s*$"
ATTRIBUTION = rf"^(?:[^0-9@]*+[0-9@].*{_WROTE}(?=\s|[:：]\s*$)|\s*(?:\S+|\p{{Lu}}\S*(?:\s\p{{Lu}}\S*){{1,4}})\s{_NOBODY}{_WROTE}\s*[:：]\s*$)"
#: Turns of a conversation that one window looks at together.
TURNS = 1024


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, r"^([\s>]*>)", 1), r"[^>]", ""))


def _body(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\s>]*>\s?", "")


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _own(text: Column) -> Column:
    """The text without quotes and without the attributions (``... wrote:``) right above them."""
    lines = F.split(text, r"\r?\n")
    # each line beside the next one, so that a lambda looks at one row of the array only
    pairs = F.arrays_zip(lines.alias("a"), F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))).alias("b"))
    keep = lambda p: ~p["a"].rlike(QUOTED) & ~(F.coalesce(p["b"].rlike(QUOTED), F.lit(False)) & p["a"].rlike(COLON) & p["a"].rlike(ATTRIBUTION))
    kept = F.array_join(F.transform(F.filter(pairs, keep), lambda p: p["a"]), "\n")
    return F.when(text.rlike(ANY_QUOTE), F.regexp_replace(F.regexp_replace(kept, r"\n{3,}", "\n\n"), r"^\s+|(?<!\s)\s+$", "")).otherwise(text)


def _previous_turn(messages: DataFrame) -> DataFrame:
    """(c, n, before): the turn before each, without one window over a whole conversation."""
    turns = messages.select("c", "n").where("c is not null and n is not null").distinct().withColumn("bucket", F.floor(F.col("n") / TURNS))
    inner = turns.withColumn("near", F.lag("n").over(Window.partitionBy("c", "bucket").orderBy("n")))
    lasts = turns.groupBy("c", "bucket").agg(F.max("n").alias("last"))
    lasts = lasts.select("c", "bucket", F.lag("last").over(Window.partitionBy("c").orderBy("bucket")).alias("far"))
    return inner.join(lasts, ["c", "bucket"], "left").select("c", "n", F.coalesce("near", "far").alias("before"))


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """Per message: the whole row in ``doc``, own (text without quotes), depth, links, reply_to.

    ``links`` has a struct (level, turn, whole) for each linked passage, in order; ``whole``
    tells a passage that equals a text from one linked by a part. ``reply_to`` is the turn
    of the latest message quoted at level 1, else the turn before; null for the first.
    Of a passage's paragraphs and lines the longest that is found links, of any length. A message never links to itself or to a
    later one. Null texts stay null; rows with a null conversation or turn stay unlinked;
    rows that share conversation and turn are parts of one message for its readers.
    """
    m = messages.select(F.struct("*").alias("doc"), col(conv_col).alias("c"), col(turn_col).cast("long").alias("n"), col(text_col).alias("t"))
    depth = F.when(F.col("t").rlike(ANY_QUOTE), F.array_max(F.transform(F.split("t", r"\r?\n"), _level))).otherwise(F.lit(0))
    m = m.select("doc", "c", "n", "t", F.md5(F.col("t").cast("binary")).alias("h"), _own(F.col("t")).alias("own"), F.coalesce(depth, F.lit(0)).alias("depth"))
    m = materialise(m, "messages")  # read by several branches below

    # passages of messages that quote, each with its units: the whole, its paragraphs and its lines
    quoting = m.where("depth > 0 and c is not null and n is not null").select("c", "n", "h", "t").dropDuplicates(["c", "n", "h"])
    line = quoting.select("c", "n", "h", F.posexplode(F.split("t", r"\r?\n")).alias("pos", "line")).withColumn("level", _level(F.col("line")))
    message = Window.partitionBy("c", "n", "h").orderBy("pos")
    line = line.withColumn("new", (F.col("level") != F.coalesce(F.lag("level").over(message), F.lit(-1))).cast("int"))
    line = line.withColumn("passage", F.sum("new").over(message)).where("level > 0").withColumn("body", _body(F.col("line")))
    passages = line.groupBy("c", "n", "h", "level", "passage").agg(F.array_sort(F.collect_list(F.struct("pos", "body"))).alias("bodies"))
    passages = passages.withColumn("bodies", F.col("bodies.body"))
    bodies = F.col("bodies")
    paragraphs = F.split(F.array_join(bodies, "\n"), r"\n\s*\n")
    whole = F.struct(F.lit(True).alias("whole"), normalised(F.array_join(bodies, " ")).alias("u"))
    single = F.transform(F.array_distinct(F.concat(paragraphs, bodies)), lambda b: F.struct(F.lit(False).alias("whole"), normalised(b).alias("u")))
    units = passages.select("c", "n", "h", "level", "passage", F.explode(F.concat(F.array(whole), single)).alias("x")).where("x.u <> ''")
    units = units.select("c", "n", "h", "level", "passage", "x.whole", F.length("x.u").alias("size"), F.md5(F.col("x.u").cast("binary")).alias("key"))

    # first holder of every own text, paragraph and line of a conversation
    parts = F.concat(F.split("own", r"\n\s*\n"), F.split("own", r"\n"))
    parts = F.transform(parts, normalised)
    held = m.where("c is not null and n is not null and own <> ''").select("c", "n", F.explode(F.array_distinct(F.concat(F.array(normalised(F.col("own"))), parts))).alias("u"))
    first = held.where("u <> ''").groupBy("c", F.md5(F.col("u").cast("binary")).alias("key")).agg(F.min("n").alias("origin"))

    found = units.join(first, ["c", "key"]).where("origin < n")
    best = found.groupBy("c", "n", "h", "level", "passage").agg(F.max(F.struct("whole", "size", "origin")).alias("b"))
    links = best.groupBy("c", "n", "h").agg(
        F.array_sort(F.collect_list(F.struct("passage", F.col("level").cast("int").alias("level"), F.col("b.origin").alias("turn"), F.col("b.whole").alias("whole")))).alias("l"),
        F.max(F.when(F.col("level") == 1, F.col("b.origin"))).alias("quoted"),
    )
    links = links.select("c", "n", "h", "quoted", F.transform("l", lambda x: F.struct(x["level"].alias("level"), x["turn"].alias("turn"), x["whole"].alias("whole"))).alias("links"))
    out = m.join(links, ["c", "n", "h"], "left").join(_previous_turn(m), ["c", "n"], "left")
    return out.select(
        "doc",
        "c",
        "n",
        "h",
        "own",
        F.col("depth").cast("int").alias("depth"),
        F.coalesce("links", F.array().cast("array<struct<level:int,turn:bigint,whole:boolean>>")).alias("links"),
        F.coalesce("quoted", "before").alias("reply_to"),
    )


def reply_ordered(messages: DataFrame) -> DataFrame:
    """The rows of ``op1_quotations``: conversations without quotes, in reply order."""
    out = link_quotations(messages)
    out = out.orderBy(F.col("c").asc_nulls_last(), F.col("reply_to").asc_nulls_first(), F.col("n").asc_nulls_last(), "h")
    return out.select(F.col("doc.conv_id").alias("conv_id"), F.col("doc.turn").alias("turn"), F.col("doc.role").alias("role"), F.col("own").alias("text"), "depth", "links", "reply_to")
