"""Wide frames: keys are checked beside the rows, and moments of full columns need one product."""

import numpy as np
import pytest

from loomfeat.operators import joins, select
from loomfeat.plans import blocks


def plan(df):
    return df._jdf.queryExecution().toString()


def test_keys_are_checked_without_a_window_over_the_rows(spark):
    left = spark.range(20).selectExpr("if(id = 7, null, id) AS k", *[f"id * {i} AS a{i}" for i in range(30)])
    right = spark.range(5, 9).selectExpr("id AS k", "id AS b")
    joined = joins.validated_left_join(left, right, "k")
    assert "Window" not in plan(joined) and joined.count() == 20
    assert sorted(map(str, joined.collect())) == sorted(map(str, left.join(right, "k", "left").collect()))
    for bad in (left.union(left.where("k is null")), left.union(left.where("k = 3"))):
        with pytest.raises(Exception, match="left side: key .* repeats"):
            joins.validated_left_join(bad, right, "k").select("a3").collect()
    two = spark.createDataFrame([(1, "x"), (1, "y")], "k int, `v w` string")
    assert joins.unique_rows(two, ["k", "v w"]).count() == 2 and joins.unique_rows(two.limit(0), "k").count() == 0


def test_modular_main_fails_on_a_repeated_key_of_any_block(spark, monkeypatch):
    app = spark.range(10).selectExpr("id AS c_custkey", "id % 2 AS target", "id * 1.5D AS x")
    parts = {"bureau_block": "c_custkey", "balance_block": "c_custkey", "card_block": "sk_id_curr", "instalment_block": "c_custkey", "pos_block": "user_id", "previous_block": "c_custkey"}

    def patched(repeated):
        monkeypatch.setattr(blocks, "application_frame", lambda spark, d: app.union(app.where("c_custkey = 4")) if repeated == "application_frame" else app)
        monkeypatch.setattr(blocks, "woe_block", lambda main, *_: main)
        monkeypatch.setattr(blocks, "application_features", lambda main: main)
        for name, key in parts.items():
            part = spark.range(12).selectExpr(f"id AS {key}", f"id + {len(name)} AS v")
            part = part.union(part.where(f"{key} = 11")) if name == repeated else part
            monkeypatch.setattr(blocks, name, lambda *_, part=part, **__: part)
        return blocks.modular_main(spark, "")

    out = patched(None)
    assert out.count() == 10 and "Window" not in plan(out)
    for name in ("application_frame", *parts):
        with pytest.raises(Exception, match="repeats"):
            patched(name).select("x").collect()


@pytest.mark.parametrize("missing", ["none", "some", "all"])
def test_moments_of_columns_with_and_without_missing_values(missing):
    r = np.random.default_rng(5)
    x, y = r.normal(size=(40, 5)), r.normal(size=(40, 3))
    if missing != "none":
        x[r.random(x.shape) < 0.3] = np.nan
        y[::3, 1] = np.nan
    if missing == "some":
        x[:, 2] = 0.5
    if missing == "all":
        x[:, 4] = np.nan
    for got, a, b in ((select._batch_moments(x), x, x), (select._batch_moments(x, y), x, y)):
        for i in range(a.shape[1]):
            for j in range(b.shape[1]):
                both = ~np.isnan(a[:, i]) & ~np.isnan(b[:, j])
                u, v = a[both, i], b[both, j]
                n = len(u)
                mu, mv = (u.mean(), v.mean()) if n else (0.0, 0.0)
                want = [n, mu, mv, ((u - mu) ** 2).sum(), ((v - mv) ** 2).sum(), ((u - mu) * (v - mv)).sum()]
                assert got[:, i, j] == pytest.approx(want, abs=1e-9)


def test_no_fit_joins_the_folds_again(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    from loomfeat.operators import scoring

    plans, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: plans.append(plan(df)) or fit(self, df, *a))
    df = spark.range(120).selectExpr("id", "id % 17 AS a", "id % 3 AS b", "if(id % 4 = 0, null, double(id % 17 > 8)) AS y")
    out = scoring.oof_scores(df, "id", "y", ["a", "b"], k=2, rounds=2, patience=1, max_depth=2)
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    assert out.oof.count() == 90 and out.test.count() == 30
