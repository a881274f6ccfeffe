"""Queries for encoders, selection and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from loomfeat.functions.exprs import row_null_count, value_map
from loomfeat.operators import encode, scoring, select, setops
from loomfeat.plans.catalog import order_activity, query
from loomfeat.sources import fixtures as fx


@query("e1_one_hot")
def q_one_hot(spark, d):
    """One 0/1 column per category value plus a NULL indicator."""
    o = fx.bureau(spark, d).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    out, new = encode.one_hot(o, ["o_orderstatus", "o_orderpriority"], clean_names=True)
    return out.select("o_orderkey", *new)


@query("e2_target_encoding")
def q_target(spark, d):
    """Mean label of the row's category, over labelled rows."""
    docs = fx.labelled_docs(spark, d)
    out = encode.target_encode(docs, ["lang", "source"], "quality", suffix="_target_encode")
    return out.select("doc_id", "lang_target_encode", "source_target_encode")


@query("e3_child_target_encoding")
def q_child_target(spark, d):
    """E3 + J5: label propagated to orders, encoded per category, aggregated per customer."""
    orders = fx.bureau(spark, d).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    labels = fx.application(spark, d).select(F.col("c_custkey").alias("o_custkey"), "target")
    return encode.child_target_encoding(
        orders, labels, "o_custkey", "target", ["o_orderpriority", "o_orderstatus"], prefix="buro_", suffix="_target_encode"
    )


@query("e4_woe")
def q_woe(spark, d):
    """E4 + J7: weight of evidence of language and source for the quality label."""
    docs = fx.labelled_docs(spark, d)
    return encode.woe_encode(docs, ["lang", "source"], "quality").select("doc_id", "lang_woe", "source_woe")


@query("e5_factorize")
def q_factorize(spark, d):
    """E5: integer codes of a categorical column (sorted domain), NULL -> -1."""
    c = fx.application(spark, d).select("c_custkey", "c_mktsegment")
    return encode.factorize(c, ["c_mktsegment"])


# Fixed values of the kernel's score-by-null-count map.
NULL_COUNT_SCORE = {0: 0.7298178, 1: 0.8178222, 2: 0.9921877}


@query("e6_value_map")
def q_value_map(spark, d):
    """P16 + E6: number of missing label columns mapped to constants (unmapped -> NULL)."""
    docs = fx.labelled_docs(spark, d)
    n = row_null_count(["quality", "toxic", "n_chars"])
    return docs.select("doc_id", n.alias("null_count"), value_map(n, NULL_COUNT_SCORE).alias("null_score"))


# ------------------------------------------------------------------ F1-F3


def wide_numeric(spark, d):
    """A wide numeric frame with near-collinear columns (FIXTURES: lineitem numerics + derived)."""
    li = fx.balance(spark, d)
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    return li.select(
        "l_orderkey",
        "l_quantity",
        "l_extendedprice",
        (price * (1 - disc) * (1 + F.col("l_tax"))).alias("paid"),
        "l_discount",
        "l_tax",
        (price / F.col("l_quantity")).alias("unit_price"),
        (price * disc).alias("discount_amount"),
        (F.col("l_quantity") * F.lit(2.0) + disc).alias("quantity_scaled"),
    )


def _corr_report(spark, d, block):
    df = wide_numeric(spark, d)
    cols = df.columns
    best = select.greatest_correlations(df, cols, block)
    rows = [(c, j, r, int(r is not None and r > 0.9 and c != "l_orderkey")) for j, (c, r) in enumerate(zip(cols, best))]
    return spark.createDataFrame(rows, "feature string, position int, max_abs_corr double, dropped int")


@query("f1_corr_prune")
def q_corr(spark, d):
    """per column, the largest |Pearson r| with an earlier column and the drop decision."""
    return _corr_report(spark, d, select.BLOCK)


@query("f1_corr_prune_gram")
def q_corr_blocks(spark, d):
    """F1 over several blocks of columns (same result)."""
    return _corr_report(spark, d, 5)


F2_KEEP = 0.6


@query("f2_ranked_prune")
def q_ranked(spark, d):
    """F2 + O4 + U2: rank the flagship block's features by their mean, drop the bottom 40 %."""
    block = order_activity(spark, d)
    feats = [c for c in block.columns if c != "c_custkey"]
    means = block.agg(*[F.avg(c).alias(c) for c in feats]).first()
    ranked = sorted(feats, key=lambda c: (-(means[c] if means[c] is not None else float("-inf")), c))
    _, dropped = select.ranked_prune(block, ranked, F2_KEEP, always_keep=[])
    dropped = set(dropped)
    rows = [(c, i + 1, int(c not in dropped)) for i, c in enumerate(ranked)]
    return spark.createDataFrame(rows, "feature string, rank int, kept int")


@query("f3_importance")
def q_importance(spark, d):
    """importances accumulated over 5 folds (per fold: feature total of the fold's rows)."""
    c = scoring.kfold(fx.application(spark, d).select("c_custkey", "c_acctbal", "c_nationkey"), "c_custkey", 5)
    per_fold = c.groupBy("fold").agg(F.sum("c_acctbal").alias("c_acctbal"), F.sum(F.col("c_nationkey").cast("double")).alias("c_nationkey"))
    long = per_fold.select("fold", F.expr("stack(2, 'c_acctbal', c_acctbal, 'c_nationkey', c_nationkey) as (feature, importance)"))
    return select.accumulate_importance(long, 5)


# ------------------------------------------------------------------ M1-M8


@query("m1_split_tag_union")
def q_split(spark, d):
    """M1 + P34 + U1 (block B1): seeded, exact 90/10 split of labelled rows, tags 1/0, unlabelled -1."""
    docs = fx.labelled_docs(spark, d)
    lab = scoring.split_flag(docs.where(F.col("quality").isNotNull()), "doc_id", 0.9, seed=1222)
    test = docs.where(F.col("quality").isNull()).select("doc_id", "lang", "source", "n_chars").withColumn("is_train", F.lit(-1))
    return setops.union_frames([lab.select("doc_id", "lang", "quality", "is_train"), test])


@query("m2_kfold")
def q_kfold(spark, d):
    """M2: five folds of equal size, labelled rows dealt in hash order."""
    docs = fx.labelled_docs(spark, d).where(F.col("quality").isNotNull())
    return scoring.kfold(docs, "doc_id", 5, seed=5407).select("doc_id", "fold")


@query("m3_stratified_kfold")
def q_stratified(spark, d):
    """M3: per-class round-robin folds in hash order (distributed prefix rank)."""
    docs = fx.labelled_docs(spark, d).where(F.col("quality").isNotNull())
    return scoring.stratified_kfold(docs, "doc_id", "quality", 5, seed=5407).select("doc_id", "quality", "fold")


@query("m6_auc")
def q_auc(spark, d):
    """M6: ROC AUC of the quality label scored by document length (ties count one half)."""
    return scoring.auc(fx.labelled_docs(spark, d), "quality", "n_chars")


@query("m6_auc_by_group")
def q_auc_group(spark, d):
    """M6: AUC per language."""
    return scoring.auc(fx.labelled_docs(spark, d), "quality", "n_chars", ["lang"])


@query("m7_gini")
def q_gini(spark, d):
    """M7: normalised Gini of the quality label by document length."""
    return scoring.gini_normalized(fx.labelled_docs(spark, d), "quality", "n_chars")


@query("m8_blend")
def q_blend(spark, d):
    """M8/M5: mean of two models' scores per row (here: two target encodings)."""
    docs = fx.labelled_docs(spark, d)
    enc = encode.target_encode(docs, ["lang", "source"], "quality", suffix="_te")
    preds = enc.select("doc_id", F.col("lang_te").alias("score")).unionByName(enc.select("doc_id", F.col("source_te").alias("score")))
    return scoring.blend(preds, "doc_id")


@query("m4_m5_oof_scores")
def q_oof(spark, d):
    """M4 + M5 + F3: 5-fold out-of-fold GBT scores, fold-averaged scores of unlabelled rows."""
    docs = fx.labelled_docs(spark, d)
    docs = encode.factorize(docs.withColumn("lang_code", F.col("lang")).withColumn("source_code", F.col("source")), ["lang_code", "source_code"])
    out = scoring.oof_scores(docs, "doc_id", "quality", ["n_chars", "lang_code", "source_code"], k=5, rounds=10, patience=5, max_depth=3)
    return out.oof.select("doc_id", "score", F.lit("oof").alias("part")).unionByName(out.test.select("doc_id", "score", F.lit("test").alias("part")))


# ------------------------------------------------------------------ O3, U1


@query("o3_top40_by_mean")
def q_top40(spark, d):
    """O3: the 40 parts with the highest mean extended price."""
    return setops.top_k_by_mean(fx.balance(spark, d), "l_partkey", "l_extendedprice", 40, "mean_price")


@query("u1_union_by_name")
def q_union(spark, d):
    """Union of differently-shaped frames by column name."""
    docs = fx.labelled_docs(spark, d)
    a = docs.where(F.col("quality").isNotNull()).select("doc_id", "lang", "quality")
    b = docs.where(F.col("quality").isNull()).select("doc_id", "lang", "n_chars")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [a, b])
