"""From documents to a training mix: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and
returns the columns of documents; the last returns the training order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeat.llm import decontaminate, jaccard, mixing, suffix_dedup, toxicity
from loomfeat.llm.common import col, drop_tables, materialise, noting_tables, table, unpack

#: Words of the shortest passage whose repeats are cut out.
REPEATED_WORDS = 51


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, docs.columns)
    return scored.where("score < 0.5").select(*unpack(scored, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays."""
    return jaccard.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that repeat are cut out; the length column follows.

    51 words take 101 bytes at least, so that no shorter window is needed to find them all.
    """
    return _measured(suffix_dedup.remove_repeats(docs, window=2 * REPEATED_WORDS - 1, min_words=REPEATED_WORDS))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark windows are cut out; the length column follows."""
    return _measured(decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum: a row for each reading of a document, by position."""
    return mixing.curriculum(docs)


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length(col("text")).cast("long")) if "n_chars" in docs.columns else docs


#: Tables that stages have written beside their output and that may still be read.
_BESIDE: list[str] = []


def _after_its_like(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, which first deletes the tables of those before it once their output is written."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _BESIDE[:] = drop_tables(spark, list(_BESIDE), docs)
        with noting_tables(_BESIDE):
            return stage(spark, docs, sf_dir)

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


STAGES = [
    ("toxicity", _after_its_like(drop_toxic)),
    ("ngram_jaccard_join", _after_its_like(drop_near_duplicates)),
    ("suffix_array_dedup", _after_its_like(cut_repeats)),
    ("benchmark_decontamination", _after_its_like(cut_benchmark)),
    ("mixing_sources", _after_its_like(mix_sources)),
]

#: No SQL: the first stage is a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
