"""Queries for the feature blocks.

Blocks with data-dependent column pruning (F1) or model scoring cannot be
expressed as one static SQL statement; they are checked on rows (and in
tests) while their parts are checked against SQL one operator at a time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomfeat.plans import blocks, kernel
from loomfeat.plans.catalog import query


@query("b04_bureau_block")
def q_bureau(spark, d):
    """B4-B9 with correlation pruning."""
    return blocks.bureau_block(spark, d)


@query("b10_balance_block")
def q_balance(spark, d):
    """B10-B13 with correlation pruning."""
    return blocks.balance_block(spark, d)


@query("b04_bureau_block_unpruned")
def q_bureau_unpruned(spark, d):
    """B4-B9 without F1 (F1's data-dependent column drop is not SQL; it is checked on its own)."""
    return blocks.bureau_block(spark, d, corr_threshold=None)


@query("b10_balance_block_unpruned")
def q_balance_unpruned(spark, d):
    """B10-B13 without F1."""
    return blocks.balance_block(spark, d, corr_threshold=None)


@query("b35_previous_block_unpruned")
def q_previous_unpruned(spark, d):
    """B35-B42 without F1 and without the data-dependent type narrowing (P31 is checked on its own)."""
    return blocks.previous_block(spark, d, corr_threshold=None, narrow=False)


@query("b14_card_block_unpruned")
def q_card_unpruned(spark, d):
    """B14-B21 without F1."""
    return blocks.card_block(spark, d, corr_threshold=None)


@query("b22_instalment_block_unpruned")
def q_instalment_unpruned(spark, d):
    """B22-B28 without F1."""
    return blocks.instalment_block(spark, d, corr_threshold=None)


@query("b29_pos_block_unpruned")
def q_pos_unpruned(spark, d):
    """B29-B34 without F1."""
    return blocks.pos_block(spark, d, corr_threshold=None)


@query("b14_card_block")
def q_card(spark, d):
    """B14-B21 with correlation pruning."""
    return blocks.card_block(spark, d)


@query("b22_instalment_block")
def q_instalment(spark, d):
    """B22-B28 with correlation pruning."""
    return blocks.instalment_block(spark, d)


@query("b29_pos_block")
def q_pos(spark, d):
    """B29-B34 with correlation pruning."""
    return blocks.pos_block(spark, d)


@query("b35_previous_block")
def q_previous(spark, d):
    """B35-B42 with correlation pruning and type narrowing."""
    return blocks.previous_block(spark, d)


@query("b43_kernel_application")
def q_k_app(spark, d):
    """Kernel application features."""
    return kernel.application(spark, d)


@query("b44_kernel_bureau")
def q_k_bureau(spark, d):
    """Kernel bureau + balance features."""
    return kernel.bureau_and_balance(spark, d)


@query("b45_kernel_previous")
def q_k_prev(spark, d):
    """Kernel previous-application features."""
    return kernel.previous(spark, d)


@query("b46_kernel_pos")
def q_k_pos(spark, d):
    """Kernel POS features."""
    return kernel.pos(spark, d)


@query("b47_kernel_instalments")
def q_k_ins(spark, d):
    """Kernel instalment features."""
    return kernel.instalments(spark, d)


@query("b48_kernel_cards")
def q_k_cards(spark, d):
    """Kernel card features."""
    return kernel.cards(spark, d)


@query("b51_kernel_main")
def q_k_main(spark, d):
    """All kernel blocks joined on the customer key, pruned by six ranked lists (F2), narrowed."""
    return kernel.kernel_main(spark, d)


@query("b49_kernel_scoring")
def q_k_scoring(spark, d):
    """5-fold scores of every customer, stopped early on AUC, as read back from the written files,
    with the AUC over the folds beside them."""
    from loomfeat.operators import joins
    from loomfeat.session import scratch_dir
    from loomfeat.sources import io

    folder = scratch_dir(spark, "kernel-scores")
    _out, summary = kernel.kernel_scoring(kernel.submission_labels(kernel.kernel_main(spark, d)), folder, rounds=10, patience=5)
    rows = [io.read_table(spark, f"{folder}/{part}", "c_custkey long, score double", fmt="csv").withColumn("part", F.lit(part)) for part in ("train", "test")]
    return joins.attach_one_row(rows[0].unionByName(rows[1]), summary)


@query("b52_modular_main")
def q_modular(spark, d):
    """The modular feature set, every block materialised and joined onto the customer spine."""
    return blocks.modular_main(spark, d)


@query("b01_load_split")
def q_load_split(spark, d):
    """B1: labelled rows cut 90/10 in hash order and tagged 1/0, unlabelled rows tagged -1, one frame."""
    from loomfeat.sources import fixtures as fx

    docs = fx.labelled_docs(spark, d)
    main, _y_train, _y_test = blocks.load_split(
        docs.where(F.col("quality").isNotNull()), docs.where(F.col("quality").isNull()), "doc_id", "quality"
    )
    return main


@query("b50_gini_scoring")
def q_gini_scoring(spark, d):
    """Scores on a prebuilt wide table (written, then read back), labels joined by key (Q19), stopped
    early on Gini, with the normalised Gini of the out-of-fold scores beside them."""
    from loomfeat.operators import columns as cols
    from loomfeat.operators import joins
    from loomfeat.session import scratch_dir

    wide = kernel.application(spark, d)
    path = scratch_dir(spark, "wide-application")
    wide.drop("target").write.mode("overwrite").parquet(path)
    prebuilt = spark.read.parquet(path)
    labels = wide.select("c_custkey", "target")
    feats = [c for c in cols.numeric_columns(prebuilt) if c != "c_custkey"]
    out, gini = kernel.gini_scoring(prebuilt, kernel.submission_labels(labels), "c_custkey", "target", feats, rounds=10, patience=5)
    rows = out.oof.select("c_custkey", "score", F.lit("train").alias("part")).unionByName(out.test.select("c_custkey", "score", F.lit("test").alias("part")))
    return joins.attach_one_row(rows, gini)
