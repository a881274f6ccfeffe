"""Splits, out-of-fold scoring and metrics.

No metric sorts the rows in one partition. AUC and Gini first aggregate to one
row per distinct score (partial aggregate), then take prefix sums over the
score order with a range-partitioned, two-pass scan: per-partition totals,
offsets from the (tiny) table of partition totals, local cumulative sums.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeat.operators.joins import attach_one_row, null_safe_join
from loomfeat.operators.selection import key_hash, mark_smallest

# ---------------------------------------------------------------- splits (M1-M3)


def split_flag(df: DataFrame, key: str, train_fraction: float = 0.9, seed: int = 1222, name: str = "is_train") -> DataFrame:
    """M1: seeded, repeatable split; ``name`` = 1 for exactly ``round(rows * train_fraction)`` rows, else 0."""
    return mark_smallest(df, key, fraction=train_fraction, seed=seed, name=name)


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 5407, name: str = "fold") -> DataFrame:
    """M2: shuffled folds in [0, k) whose sizes differ by one at most: rows in hash order, dealt in turn."""
    ranked = prefix_rank(df.withColumn("__h", key_hash(key, seed)), [], ["__h", key], name="__r")
    return ranked.withColumn(name, F.pmod(F.col("__r") - 1, F.lit(k)).cast("int")).drop("__h", "__r")


def _range_partitions(df: DataFrame) -> int:
    """Range partitions for a distributed rank: the session's shuffle partition count
    (sized for the data by whoever runs the job), at least the cluster's parallelism."""
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(int(conf), df.sparkSession.sparkContext.defaultParallelism)


def prefix_rank(df: DataFrame, partition: Sequence[str], order: Sequence[str], name: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """1-based row number within ``partition`` groups in ``order``, computed without
    putting a whole group in one task.

    Rows are range-partitioned on (partition, order): a large group spans many
    tasks. The partitioned rows are checkpointed, so the task id of every row
    is fixed. Each task's row count per group is aggregated (one row per task
    and group), turned into offsets by a window over that small table, and
    added to a local row number.
    """
    keys = [*partition, *order]
    n = num_partitions or _range_partitions(df)
    # materialised once: both branches below must see the same task of every row (a re-run
    # could coalesce or re-split partitions differently under AQE)
    r = df.repartitionByRange(n, *[F.col(c) for c in keys]).withColumn("__pid", F.spark_partition_id()).checkpoint()
    counts = r.groupBy("__pid", *partition).agg(F.count(F.lit(1)).alias("__cnt"))
    wo = Window.partitionBy(*partition).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(wo), F.lit(0))).drop("__cnt")
    wl = Window.partitionBy("__pid", *partition).orderBy(*[F.col(c) for c in order])
    local = r.withColumn("__local", F.row_number().over(wl))
    out = null_safe_join(local, offsets, ["__pid", *partition])
    return out.withColumn(name, F.col("__off") + F.col("__local")).drop("__pid", "__off", "__local")


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 5407, name: str = "fold") -> DataFrame:
    """M3: per class, rows in hash order are dealt round-robin into ``k`` folds."""
    h = df.withColumn("__h", key_hash(key, seed))
    ranked = prefix_rank(h, [label], ["__h", key], name="__r")
    return ranked.withColumn(name, F.pmod(F.col("__r") - 1, F.lit(k)).cast("int")).drop("__h", "__r")


# ---------------------------------------------------------------- metrics (M6, M7)


def _score_table(df: DataFrame, label: str, score: str, group: Sequence[str]) -> DataFrame:
    return (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*group, score)
        .agg(
            F.count(F.lit(1)).alias("__n"),
            F.sum(F.col(label).cast("double")).alias("__y"),
        )
    )


def _cumulative(df: DataFrame, group: Sequence[str], order: str, cols: Sequence[str], descending: bool) -> DataFrame:
    """Exclusive prefix sums of ``cols`` over ``order`` within ``group`` (range-partitioned)."""
    n = _range_partitions(df)
    o = F.col(order).desc() if descending else F.col(order).asc()
    r = df.repartitionByRange(n, *[F.col(g) for g in group], o).withColumn("__pid", F.spark_partition_id()).checkpoint()
    tot = r.groupBy("__pid", *group).agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    wo = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("__pid", *group, *[F.coalesce(F.sum(f"__t_{c}").over(wo), F.lit(0.0)).alias(f"__o_{c}") for c in cols])
    wl = Window.partitionBy("__pid", *group).orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
    local = r.select("*", *[F.coalesce(F.sum(c).over(wl), F.lit(0.0)).alias(f"__l_{c}") for c in cols])
    out = null_safe_join(local, tot, ["__pid", *group])
    return out.select(
        *[c for c in df.columns], *[(F.col(f"__o_{c}") + F.col(f"__l_{c}")).alias(f"cum_{c}") for c in cols]
    )


def auc(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """M6: ROC AUC with ties counted one half; one row per ``group`` with column ``auc``."""
    group = list(group)
    t = _score_table(df, label, score, group)
    t = t.withColumn("__pos", F.col("__y")).withColumn("__neg", F.col("__n") - F.col("__y"))
    c = _cumulative(t, group, score, ["__neg"], descending=False)
    # positives at this score beat all negatives below it and tie with the ones at it
    c = c.withColumn("__w", F.col("__pos") * (F.col("cum___neg") + 0.5 * F.col("__neg")))
    res = c.groupBy(*group).agg(
        F.sum("__w").alias("__w"), F.sum("__pos").alias("__P"), F.sum("__neg").alias("__N")
    )
    return res.select(*group, F.try_divide(F.col("__w"), F.col("__P") * F.col("__N")).alias("auc"))


def gini_normalized(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """M7: normalised Gini = Gini(y, score) / Gini(y, y); ties in the score are averaged.

    Gini(y, p) = L / (Y * n) - (n + 1) / (2 n), where L is the Lorenz sum of y
    sorted by p descending: a tie group of m rows with total y_g at cumulative
    total C contributes m*C + y_g*(m+1)/2 (the mean over orders of the group).
    """
    group = list(group)

    def lorenz(by: str) -> DataFrame:
        t = (
            df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
            .groupBy(*group, F.col(by).alias("__s"))
            .agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col(label).cast("double")).alias("__y"))
        )
        c = _cumulative(t, group, "__s", ["__y"], descending=True)
        c = c.withColumn("__l", F.col("__n") * F.col("cum___y") + F.col("__y") * (F.col("__n") + 1) / 2.0)
        g = c.groupBy(*group).agg(F.sum("__l").alias("__L"), F.sum("__y").alias("__Y"), F.sum("__n").alias("__N"))
        return g.select(
            *group,
            (F.try_divide(F.col("__L"), F.col("__Y") * F.col("__N")) - (F.col("__N") + 1) / (2.0 * F.col("__N"))).alias(f"__g_{by == label}"),
        )

    a, b = lorenz(score), lorenz(label)
    j = a.join(b, group, "inner") if group else attach_one_row(a, b)
    return j.select(*group, F.try_divide(F.col("__g_False"), F.col("__g_True")).alias("gini"))


def fold_auc_summary(scored: DataFrame, label: str, score: str, fold: str = "fold") -> DataFrame:
    """M6: per-fold AUC, their mean and population std, and the pooled out-of-fold AUC."""
    per = auc(scored, label, score, [fold])
    summary = per.agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"))
    pooled = auc(scored, label, score).withColumnRenamed("auc", "auc_oof")
    return attach_one_row(summary, pooled)


def blend(predictions: DataFrame, key: str, score: str = "score", name: str = "score") -> DataFrame:
    """M5/M8: mean prediction per id over folds, seeds or models."""
    return predictions.groupBy(key).agg(F.avg(score).alias(name))


# ---------------------------------------------------------------- out-of-fold scoring


class Scored(NamedTuple):
    """Out-of-fold scores, fold-averaged scores of the unlabelled rows, importances, and the metric by fold and round."""

    oof: DataFrame
    test: DataFrame
    importance: DataFrame
    stages: DataFrame


def best_round(values: Sequence[float | None], patience: int) -> int:
    """The round (from 1) of the best value, looking no further than ``patience`` rounds without a better one."""
    best, at = None, 1
    for r, v in enumerate(values, 1):
        if v is not None and (best is None or v > best):
            best, at = v, r
        elif r - at >= patience:
            break
    return at


def _staged(model, df: DataFrame) -> DataFrame:
    """``df`` with ``__margins``: the ensemble's margin after each round, every tree applied once."""
    for i, tree in enumerate(model.trees):
        df = tree.setFeaturesCol("__features").setPredictionCol(f"__t{i}").transform(df)
    parts = F.array(*[F.col(f"__t{i}") * F.lit(float(w)) for i, w in enumerate(model.treeWeights)])
    df = df.withColumn("__parts", parts).drop(*[f"__t{i}" for i in range(len(model.trees))])
    sums = F.transform(F.sequence(F.lit(1), F.size("__parts")), lambda r: F.aggregate(F.slice("__parts", F.lit(1), r), F.lit(0.0), lambda t, x: t + x))
    return df.withColumn("__margins", sums).drop("__parts")


def _probability(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def oof_scores(
    df: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    k: int = 5,
    seed: int = 5407,
    rounds: int = 20,
    patience: int = 5,
    metric: str = "auc",
    max_depth: int = 5,
    step_size: float = 0.1,
) -> Scored:
    """K-fold out-of-fold scores with Spark ML gradient-boosted trees, stopped early.

    For each fold ``rounds`` trees are grown on the others. The margins after every round are
    scored on the held-out fold with this module's distributed ``auc`` or ``gini_normalized``
    (``metric``), and the ensemble is cut at the best round, as boosting that stops after
    ``patience`` rounds without a better value would cut it. Labelled rows get a score from
    the model that did not see their fold; unlabelled rows get the mean score of the k cut
    models, and the importances are those of the trees that were kept. Re-aimed from
    LightGBM (see README): missing feature values are filled with 0 for the tree learner.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from loomfeat.operators.select import accumulate_importance

    feats = list(features)
    base = df.select(key, label, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(feats)])
    # materialise the assembled rows once: every fold and every boosting
    # iteration reads them, the upstream feature plan is not recomputed
    vec = VectorAssembler(inputCols=[f"f{i}" for i in range(len(feats))], outputCol="__features").transform(base).select(key, label, "__features").checkpoint()
    labelled = vec.where(F.col(label).isNotNull())
    # the folds are joined once too: every pass of every fit would shuffle the vectors for it again
    train = labelled.join(kfold(labelled.select(key).distinct(), key, k, seed), key).withColumn(label, F.col(label).cast("double")).checkpoint()
    test = vec.where(F.col(label).isNull())
    measure = {"auc": auc, "gini": gini_normalized}[metric]
    oof, tests, importances, stages = [], [], [], []
    spark = df.sparkSession
    for fold in range(k):
        gbt = GBTClassifier(featuresCol="__features", labelCol=label, maxIter=rounds, maxDepth=max_depth, stepSize=step_size, seed=seed)
        model = gbt.fit(train.where(F.col("fold") != fold))
        held = _staged(model, train.where(F.col("fold") == fold)).select(key, label, "fold", "__margins").checkpoint()
        long = held.select(label, F.posexplode("__margins").alias("round", "score"))
        values = {r["round"]: r[metric] for r in measure(long, label, "score", ["round"]).collect()}
        values = [values.get(r) for r in range(len(model.trees))]
        best = best_round(values, patience)
        stages += [(fold, r, v, r == best) for r, v in enumerate(values, 1)]
        oof.append(held.select(key, label, "fold", _probability(F.get("__margins", F.lit(best - 1))).alias("score")))
        tests.append(_staged(model, test).select(key, _probability(F.get("__margins", F.lit(best - 1))).alias("score")))
        kept = sum(abs(w) * t.featureImportances.toArray() for w, t in zip(model.treeWeights[:best], model.trees[:best]))
        kept = kept / kept.sum() if kept.sum() > 0 else kept
        importances += [(f, float(v), fold) for f, v in zip(feats, kept)]
    importance = accumulate_importance(spark.createDataFrame(importances, "feature string, importance double, fold int"), k)
    table = spark.createDataFrame(stages, f"fold int, round int, {metric} double, best boolean")
    return Scored(reduce(DataFrame.unionByName, oof), blend(reduce(DataFrame.unionByName, tests), key), importance, table)
