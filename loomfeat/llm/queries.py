"""One registered query per operator; each reads whole tables and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomfeat.llm import balltree, conversations, decontaminate, epsilon_grid, jaccard, langid, mixing, prefix_trie, quality, suffix_dedup, toxicity, urls, whitening
from loomfeat.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_mix(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark, sf_dir):
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_jaccard(spark, sf_dir):
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query
def op2_balltree(spark, sf_dir):
    return balltree.top_k(table(spark, sf_dir, "embeddings"))


@query
def op10_langid(spark, sf_dir):
    return langid.predicted(table(spark, sf_dir, "documents"))


@query
def op1_quotations(spark, sf_dir):
    return conversations.reply_ordered(table(spark, sf_dir, "conversations"))


@query
def op8_urls(spark, sf_dir):
    return urls.judged(table(spark, sf_dir, "pages"))


@query
def op11_whitening(spark, sf_dir):
    return whitening.digests(table(spark, sf_dir, "embeddings"))


@query
def op13_near_vectors(spark, sf_dir):
    return epsilon_grid.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))
