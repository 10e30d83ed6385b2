"""The registered training queries run the operators' own settings."""

import pytest
from pyspark.sql import functions as F

from vigil.operators import train as TR
from vigil.plans import queries as Q


class Stop(Exception):
    pass


def _rows(spark, n=400):
    df = spark.range(n).select(F.format_string("%05d", "id").alias("txn_id"), (F.col("id") % 4 == 0).cast("int").alias("Class"),
                               (F.col("id") % 5 == 0).alias("is_val"), F.lit(1.0).alias("weight"))
    return df.withColumns({c: F.col("Class") + (F.abs(F.hash("txn_id", F.lit(c))) % 100) / 40 for c in Q.TRAIN_FEATURES})


@pytest.mark.parametrize("name, variant", [(n, "xgb") for n in (
    "random_search", "fold_ap", "fold_importance_summary", "permutation_importance", "importances", "stream_scores", "score_requests")])
def test_estimator_of_query(spark, monkeypatch, name, variant):
    made = []

    def fit(train, features, estimator, label="Class"):
        made.append((train, estimator))
        raise Stop

    monkeypatch.setattr(TR, "fit", fit)
    monkeypatch.setattr(Q, "_training_setup", lambda *_: (_rows(spark), _rows(spark), None))
    with pytest.raises(Stop):
        Q.QUERIES[name](spark, "unused")
    train, est = made[0]
    want = dict(TR.XGB_DEFAULTS if variant == "xgb" else TR.LGBM_DEFAULTS)
    if name == "random_search":  # drawn by the trial
        want = {k: v for k, v in want.items() if k not in ("maxDepth", "stepSize", "subsamplingRate")}
    assert {k: est.getOrDefault(k) for k in want} == want
    assert est.getOrDefault("validationIndicatorCol") == "is_val"
    assert {r.is_val for r in train.select("is_val").distinct().collect()} == {True, False}


@pytest.mark.parametrize("name, variant", [("gbt_scores", "xgb"), ("gbt_metrics", "lgbm"), ("early_stopping", "xgb")])
def test_patient_queries(spark, monkeypatch, name, variant):
    asked = []

    def fit(train, features, *args, **kwargs):
        asked.append((list(features), args, kwargs))
        raise Stop

    monkeypatch.setattr(TR, "fit_with_patience", fit)
    monkeypatch.setattr(Q, "_training_setup", lambda *_: (_rows(spark), _rows(spark), None))
    with pytest.raises(Stop):
        Q.QUERIES[name](spark, "unused")
    assert asked == [(Q.TRAIN_FEATURES, (), {} if variant == "xgb" else {"variant": variant})]


def test_trials_and_repeats(spark, monkeypatch):
    asked = {}
    draw = TR.sample_grid
    monkeypatch.setattr(Q, "_training_setup", lambda *_: (_rows(spark), _rows(spark), None))
    monkeypatch.setattr(Q.scale_ops, "apply_for_serving", lambda df, _: df)
    monkeypatch.setattr(TR, "sample_grid", lambda space, n, seed: asked.update(trials=n) or draw(space, 0, seed))
    Q.QUERIES["random_search"](spark, "unused")
    monkeypatch.setattr(TR, "fit", lambda *_: TR.TrainResult(None, [], "Class"))
    monkeypatch.setattr(TR, "permutation_importance", lambda *a, n_repeats=5, **_: asked.update(repeats=n_repeats))
    Q.QUERIES["permutation_importance"](spark, "unused")
    assert asked == {"trials": Q.QUERY_TRIALS, "repeats": 5} and TR.SEARCH_TRIALS == 300
