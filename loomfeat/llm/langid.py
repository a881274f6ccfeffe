"""Language ID (operator 10): segmentation-marginalised unigrams.

Each language is a unigram model over the pieces of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, by the forward algorithm;
a text's is the product over its words. Piece probabilities are learned per language by
expectation maximisation (forward and backward) on a bounded sample of labelled texts.
Words are scored many at a time in numpy, each distinct one once while it is remembered.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeat.llm.common import col, held_out, map_docs, materialise, parts, small_batches, unpack

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LETTERS = re.compile(r"[^\W\d_]+")
MARK = "▁"  # begins a word, in the vocabulary and in the words scored
WORD_CHARS = 32  # longer words are scored as pieces of this length
UNKNOWN = 1e-7  # probability of a character that no piece covers
REMEMBERED = 200_000
CHUNK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 19


def read_vocabulary(path: str = VOCABULARY) -> list[str]:
    """Distinct lower-cased pieces of letters, with or without the word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if p == MARK or p.removeprefix(MARK).isalpha()})


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased and cut to the longest length scored."""
    out = LETTERS.findall(text.lower())
    if max(map(len, out), default=0) > WORD_CHARS:
        out = [w[i : i + WORD_CHARS] for w in out for i in range(0, len(w), WORD_CHARS)]
    return out


class Pieces:
    """Hash table of the vocabulary, probed for many substrings at once."""

    def __init__(self, vocabulary: list[str]):
        self.longest = max(map(len, vocabulary), default=1)
        self.size = len(vocabulary)
        hashes = np.zeros(self.size, np.uint64)
        for i, p in enumerate(vocabulary):
            h = 0
            for ch in p:
                h = (h * int(_BASE) + ord(ch) + 1) & (1 << 64) - 1
            hashes[i] = h
        self.keys = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.ids = np.full(1 << _SLOT_BITS, -1, np.int32)
        for i, (h, s) in enumerate(zip(hashes, self.slot(hashes).tolist())):
            while self.ids[s] >= 0:
                s = (s + 1) % (1 << _SLOT_BITS)
            self.keys[s], self.ids[s] = h, i

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece id of each hash, -1 if none."""
        out = np.full(len(h), -1, np.int32)
        todo, s = np.arange(len(h)), self.slot(h)
        while len(todo):
            ids = self.ids[s]
            hit = (ids >= 0) & (self.keys[s] == h[todo])
            out[todo[hit]] = ids[hit]
            go = (ids >= 0) & ~hit
            todo, s = todo[go], (s[go] + 1) % (1 << _SLOT_BITS)
        return out


class Lattice:
    """Pieces of a set of words by end position and length; words sorted by length, long first."""

    def __init__(self, pieces: Pieces, words: list[str]):
        lengths = np.array([len(w) for w in words], np.int64) + 1
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        width = int(self.lengths[0]) if len(words) else 0
        chars = np.zeros((len(words), max(width, 1)), np.uint32)
        chars[:, 0] = ord(MARK)
        if width > 1:
            flat = np.array([words[i] for i in self.order], dtype=f"U{width - 1}")
            chars[:, 1:] = flat.view(np.uint32).reshape(len(words), width - 1)
        self.width = width
        prefix = np.zeros((len(words), width + 1), np.uint64)
        for j in range(width):
            prefix[:, j + 1] = prefix[:, j] * _BASE + chars[:, j] + np.uint64(1)
        powers = [np.uint64(pow(int(_BASE), i, 1 << 64)) for i in range(min(width, pieces.longest) + 1)]
        self.arcs: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[]]
        self.alive = [len(words)]
        for j in range(1, width + 1):
            n = int(np.searchsorted(-self.lengths, -j, side="right"))
            self.alive.append(n)
            here = []
            for size in range(1, min(j, pieces.longest) + 1):
                ids = pieces.find(prefix[:n, j] - prefix[:n, j - size] * powers[size])
                if size == 1:
                    here.append((1, np.arange(n), np.where(ids >= 0, ids, pieces.size)))
                elif len(rows := np.flatnonzero(ids >= 0)):
                    here.append((size, rows, ids[rows]))
            self.arcs.append(here)

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Prefix probabilities (word, position, model); ``p`` has a last row for unknown characters."""
        alpha = np.zeros((len(self.lengths), self.width + 1, p.shape[1]))
        alpha[:, 0] = 1
        for j in range(1, self.width + 1):
            for size, rows, ids in self.arcs[j]:
                alpha[rows, j] += alpha[rows, j - size] * p[ids]
        return alpha

    def totals(self, p: np.ndarray) -> np.ndarray:
        """Log probability of each word, in the caller's order."""
        out = np.empty((len(self.lengths), p.shape[1]))
        if len(out):
            alpha = self.forward(p)
            out[self.order] = np.log(alpha[np.arange(len(alpha)), self.lengths])
        return out

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (one model), words weighted by their counts."""
        alpha = self.forward(p[:, None])[:, :, 0]
        beta = np.zeros_like(alpha)
        at = np.arange(len(alpha))
        beta[at, self.lengths] = counts[self.order] / alpha[at, self.lengths]
        uses = np.zeros(len(p))
        for j in range(self.width, 0, -1):
            for size, rows, ids in self.arcs[j]:
                flow = beta[rows, j] * p[ids]
                uses += np.bincount(ids, flow * alpha[rows, j - size], len(p))
                beta[rows, j - size] += flow
        return uses


class Model:
    """Languages in code-point order and their piece probabilities."""

    def __init__(self, vocabulary: list[str], languages: list[str], p: np.ndarray):
        self.vocabulary, self.languages, self.p = vocabulary, languages, p

    def scorer(self):
        """A function from texts to (language, score); it remembers words between calls."""
        pieces, seen = Pieces(self.vocabulary), {}
        table = np.zeros((0, len(self.languages)))

        def run(texts: list[str | None]) -> tuple[list[str], list[float]]:
            nonlocal table
            if len(seen) > REMEMBERED:
                seen.clear()
                table = table[:0]
            docs = [[w for w in words_of(t)] if t else [] for t in texts]
            fresh: dict[str, int] = {}
            for words in docs:
                for w in words:
                    if w not in seen and w not in fresh:
                        fresh[w] = len(fresh)
            new = list(fresh)
            rows = [table]
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                part = [w if w.isalpha() else "" for w in part]  # a run without letters says nothing
                rows.append(np.where(np.array([[bool(w)] for w in part]), Lattice(pieces, part).totals(self.p), 0.0))
            base = len(table)
            table = np.concatenate(rows)
            seen.update((w, base + i) for w, i in fresh.items())
            langs, scores = [], []
            for words in docs:
                if not any(any(ch.isalpha() for ch in w) for w in words) or not self.languages:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                total = table[[seen[w] for w in words]].sum(0)
                share = np.exp(total - total.max())
                best = int(np.argmax(total))
                langs.append(self.languages[best])
                scores.append(float(share[best] / share.sum()))
            return langs, scores

        return run


def learn(vocabulary: list[str], samples: dict[str, Counter], rounds: int = 4, smooth: float = 0.05) -> Model:
    """Per language: start from even probabilities, then reestimate from expected uses."""
    pieces, languages = Pieces(vocabulary), sorted(samples)
    p = np.zeros((len(vocabulary) + 1, len(languages)))
    for g, lang in enumerate(languages):
        words = [w for w in samples[lang] if w.isalpha()]
        counts = np.array([samples[lang][w] for w in words], np.float64)
        lattice = Lattice(pieces, words)
        own = np.append(np.full(len(vocabulary), 1 / max(1, len(vocabulary))), UNKNOWN)
        for _ in range(rounds if words else 0):
            uses = lattice.expected(own, counts)[:-1] + smooth
            own = np.append(uses / uses.sum(), UNKNOWN)
        p[:, g] = own
    return Model(vocabulary, languages, p)


def fit_languages(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", per_language: int = 400, vocabulary: str = VOCABULARY) -> Model:
    """Learn every non-null label from at most ``per_language`` whole training texts each.

    The texts are drawn in hash order of the id among rows that are not held out; labels of
    which no drawn text has a letter are not learned. Words are counted in the tasks.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(col(id_col).alias("i"), col(lang_col).cast("string").alias("l"), col(text_col).alias("t"))
    rows = rows.where(F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("i"), 4, 2)).withColumn("k", F.xxhash64("t")).withColumn("h", F.xxhash64("i"))
    # the rows are known by their keys first; texts are moved of drawn rows only
    order = Window.partitionBy("l", F.pmod("h", F.lit(64))).orderBy("h", "i", "k")
    near = rows.select("l", "i", "h", "k").withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_language).drop("r")
    ranked = near.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h", "i", "k"))).where(F.col("r") <= per_language)
    drawn = materialise(ranked.groupBy("l", "i", "h", "k").agg(F.count("*").alias("copies")), "language-sample")
    d = drawn.select(F.col("l").alias("l2"), F.col("i").alias("i2"), F.col("h").alias("h2"), F.col("k").alias("k2"), "copies")
    texts = rows.join(d, (F.col("l") == F.col("l2")) & (F.col("h") == F.col("h2")) & (F.col("k") == F.col("k2")) & F.col("i").eqNullSafe(F.col("i2")))
    texts = texts.dropDuplicates(["l", "i", "k"]).select("l", "t", "copies")

    def run(batches):
        for b in (part for batch in batches for part in parts(batch)):
            for lang, text, copies in zip(*[c.to_pylist() for c in b.columns]):
                found = Counter(w for w in words_of(text) if w.isalpha())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.string()), pa.array([n * copies for n in found.values()], pa.int64())], names=["l", "w", "n"])

    counted = materialise(texts.mapInArrow(run, "l string, w string, n long").groupBy("l", "w").agg(F.sum("n").alias("n")), "language-words")
    found: dict[str, dict[str, int]] = {}
    for r in counted.toLocalIterator():
        found.setdefault(r.l, {})[r.w] = r.n
    return learn(read_vocabulary(vocabulary), {lang: Counter(dict(sorted(words.items()))) for lang, words in found.items()})


def predict_languages(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept columns in ``doc``, lang_pred and score (its share of the likelihood).

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned.
    Equal likelihoods go to the first language by code point.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = shared.value.scorer()
        for (texts,) in batches:
            texts, langs, scores = texts.to_pylist(), [], []
            at = 0
            while at < len(texts):
                until, size = at, 0
                while until < len(texts) and size < CHUNK:
                    size += len(texts[until] or "")
                    until += 1
                a, b = score(texts[at:until])
                langs += a
                scores += b
                at = until
            yield [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return map_docs(docs, keep, {"t": text_col}, run, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predicted(docs: DataFrame) -> DataFrame:
    """The digest rows of ``op10_langid``."""
    out = predict_languages(docs, fit_languages(docs), ["doc_id"])
    return out.select(*unpack(out, ["doc_id"]), held_out(F.col("doc.doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
