"""URL filters (operator 8): rules, then host word segmentation and naive Bayes.

Rules judge the urls they fit. The others are judged by a multinomial naive Bayes over
words of host and path, learned from the urls that rules judge. Names without blanks are
split into words by Viterbi over unigrams, which are counted in the text of all pages. Each
name meets the counts of its substrings, and each url those of its words, by shuffled joins,
so that neither model is cut to a size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import col, lower_ascii, materialise, parts, small_batches

#: Fixed values of the contract: host, path prefix, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: Letters of the longest run that stands for one unknown word.
WORD_CHARS = 20
#: Parts into which joins deal a key that many rows share (``com``, ``a``).
SALTS = 16
#: Log odds are summed as whole multiples of 1 / ODDS, so that a sum does not depend on its order.
ODDS = 10**12
_HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
_OPENS = re.compile(r"<(script|style)\b|<", re.I)
_ENDS = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style")}
_WORD = re.compile(r"[a-z]+")
_PART = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


def visible(html: str) -> str:
    """The text with a blank for each match of ``_HIDDEN``: scripts, styles and tags; what is not closed stays.

    One pass, which the pattern is not: where an end is looked for in vain once, it is not looked for again.
    """
    out, at, closed = [], 0, {"script": True, "style": True, "tag": True}
    for m in _OPENS.finditer(html):
        if m.start() < at:
            continue
        name, end = (m[1] or "").lower(), -1
        if name and closed[name]:
            found = _ENDS[name].search(html, m.end())
            end = found.end() if found else -1
            closed[name] = found is not None
        if end < 0 and closed["tag"]:
            end = html.find(">", m.start()) + 1 or -1
            closed["tag"] = end > 0
        if end > 0:
            out += [html[at : m.start()], " "]
            at = end
    return "".join([*out, html[at:]])


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ``://``."""
    host = lower_ascii(F.regexp_extract(url, r"://([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Most probable split of a name into words of the unigram model.

    A run of n letters that is no word has the probability ``10 / (total * 10^n)``; ``counts``
    need no more than the words that occur in the names, if ``total`` is that of all words.
    """

    def __init__(self, counts: dict[str, int], total: int = 0):
        self.total = total or sum(counts.values()) or 1
        self.lengths = sorted({*range(1, WORD_CHARS + 1), *map(len, counts)}, reverse=True)
        self.cost = {w: -math.log(c / self.total) for w, c in counts.items()}
        self.seen: dict[str, list[str]] = {}

    def split(self, name: str) -> list[str]:
        if name not in self.seen:
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[name] = self._viterbi(name)
        return self.seen[name]

    def _viterbi(self, name: str) -> list[str]:
        best, back = [0.0], [0]
        strange = math.log(self.total) - math.log(10)
        for j in range(1, len(name) + 1):
            options = []
            for i in (j - n for n in self.lengths if n <= j):
                w = name[i:j]
                if j - i <= WORD_CHARS or w in self.cost:
                    options.append((best[i] + self.cost.get(w, strange + (j - i) * math.log(10)), i))
            cost, i = min(options)
            best.append(cost)
            back.append(i)
        out, j = [], len(name)
        while j:
            out.append(name[back[j] : j])
            j = back[j]
        return out[::-1]


def names_of(host: str, path: str) -> Counter:
    """(mark, name) of host and path with their numbers; digits read ``#``."""
    return Counter((mark, "#" if part[0].isdigit() else part) for mark, text in (("h:", host), ("p:", path.lower())) for part in _PART.findall(text))


def count_words(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, number) over all pages' visible text."""

    def run(batches):
        for b in (part for batch in batches for part in parts(batch)):
            counts: Counter = Counter()
            for html in b.column(0).to_pylist():
                if html:
                    counts.update(_WORD.findall(visible(html).lower()))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "number"])

    return pages.select(col(html_col)).mapInArrow(run, "word string, number long").groupBy("word").agg(F.sum("number").alias("number"))


def _salted(many: DataFrame, few: DataFrame, key: str, by: list[str], how: str = "inner") -> DataFrame:
    """Join with the rows of ``many`` that share a key dealt to ``SALTS`` tasks by the columns ``by``."""
    many = many.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))
    few = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return many.join(few, [key, "salt"], how).drop("salt")


def split_names(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, tokens): the split of each name by the words among its substrings."""
    total = words.agg(F.sum("number")).first()[0]
    # only substrings as long as some word can be one
    lengths = sorted(r.n for r in words.select(F.length("word").alias("n")).distinct().collect())

    def substrings(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                found = (name[i : i + n] for n in lengths for i in range(len(name) - n + 1))
                for some in batched(found if _WORD.fullmatch(name) else (), 4096):
                    some = list(set(some))
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some, pa.string())], names=["name", "word"])

    def split(batches):
        for b in batches:
            held, found = b.column(0).to_pylist(), b.column(1).to_pylist()
            tokens = [Segmenter({w["word"]: w["number"] for w in own or []}, total or 0).split(name) for name, own in zip(held, found)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tokens, pa.list_(pa.string()))], names=["name", "tokens"])

    asked = names.mapInArrow(substrings, "name string, word string")
    # the many words meet the distinct substrings once; the few that are one go back to the names
    hits = materialise(words.join(asked.select("word").distinct(), "word", "left_semi"), "name-words")
    known = _salted(asked, hits, "word", ["name"]).groupBy("name").agg(F.collect_list(F.struct("word", "number")).alias("words"))
    return names.join(known, "name", "left").select("name", "words").mapInArrow(split, "name string, tokens array<string>")


def judge(pages: DataFrame, keep: list[str], url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """The kept columns in ``doc``, host, path, rule, verdict.

    Word counts and the classifier (add-one smoothing) cover all pages. A tie or nothing
    learned allows; if rules know one verdict only, it is everyone's. Null urls have no words
    and get the prior's verdict; null or empty html teaches no words. Repeated rows are
    judged alike.
    """
    small_batches(pages.sparkSession)
    host, path = host_and_path(col(url_col))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    split = pages.select(F.struct(*[col(c) for c in keep]).alias("doc"), host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("known", verdict)
    urls = materialise(split.groupBy("host", "path", "known").agg(F.count("*").alias("rows")), "urls")
    rows = {r.known: r.n for r in urls.where("known is not null").groupBy("known").agg(F.sum("rows").alias("n")).collect()}
    if len(rows) < 2:
        return split.select("doc", "host", "path", "rule", F.coalesce("known", F.lit(next(iter(rows), "allow"))).alias("verdict"))

    def names(batches):
        for b in (part for batch in batches for part in parts(batch)):
            found = [(i, *k, m) for i, (h, p) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())) for k, m in names_of(h, p).items()]
            at = pa.array([f[0] for f in found], pa.int64())
            more = [pa.array([f[k] for f in found], t) for k, t in ((1, pa.string()), (2, pa.string()), (3, pa.int64()))]
            yield pa.RecordBatch.from_arrays([c.take(at) for c in b.columns] + more, names=[*b.schema.names, "mark", "name", "times"])

    named = materialise(urls.mapInArrow(names, T.StructType([*urls.schema.fields, *[T.StructField(n, T.StringType()) for n in ("mark", "name")], T.StructField("times", T.LongType())])), "url-names")
    segments = materialise(split_names(named.select("name").distinct(), materialise(count_words(pages, html_col), "words")), "name-tokens")
    tokens = _salted(named, segments, "name", ["host", "path"]).select("host", "path", "known", "rows", "times", "mark", F.explode("tokens").alias("token"))
    tokens = materialise(tokens.groupBy("host", "path", "known", "rows", F.concat("mark", "token").alias("token")).agg(F.sum("times").alias("times")), "url-tokens")

    seen = lambda v: F.sum(F.when(F.col("known") == v, F.col("rows") * F.col("times")).otherwise(0)).alias(v)
    learned = materialise(tokens.where("known is not null").groupBy("token").agg(seen("allow"), seen("block")), "learned-tokens")
    size, allow, block = learned.agg(F.count("*"), F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))).first()
    strange = math.log(allow + size + 1) - math.log(block + size + 1)
    prior = math.log((rows["block"] + 1) / (rows["allow"] + 1))
    odds = learned.select("token", F.round((F.log(F.col("block") + 1) - F.log(F.col("allow") + 1) + F.lit(strange)) * ODDS).cast("long").alias("odds"))
    asked = _salted(tokens.where("known is null"), odds, "token", ["host", "path"], "left")
    scores = asked.groupBy("host", "path").agg(F.sum(F.col("times") * F.coalesce("odds", F.lit(round(strange * ODDS)))).alias("score"))
    judged_urls = split.where("known is null").join(scores, ["host", "path"], "left")
    guess = F.when(F.coalesce("score", F.lit(0)) + F.lit(round(prior * ODDS)) > 0, "block").otherwise("allow")
    out = judged_urls.select("doc", "host", "path", "rule", guess.alias("verdict"))
    return out.union(split.where("known is not null").select("doc", "host", "path", "rule", F.col("known").alias("verdict")))


def judged(pages: DataFrame) -> DataFrame:
    """The digest rows of ``op8_urls``."""
    return judge(pages, ["page_id"]).select(F.col("doc.page_id").alias("page_id"), "host", "path", "rule", "verdict")
