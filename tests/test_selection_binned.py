"""Cross-validated selection and the search: the figures of Spark's cross-validator, and large tables summed by their bins once."""

import numpy as np
import pytest
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from vigil.operators import train as TR

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n = 2400
    a, b = rng.integers(0, 20, n) / 4, rng.integers(0, 9, n) * 10.0
    y = (a + b / 20 + rng.normal(scale=1.0, size=n) > 5).astype(int)
    data = [(float(a[i]), float(b[i]), int(y[i]), bool(i % 4 == 0), int(i % 3), 1.0) for i in range(n)]
    return spark.createDataFrame(data, "a double, b double, Class int, is_val boolean, fold int, weight double").repartition(4, "a").checkpoint()


def _aps(df):
    return {r.algorithm: r.cv_average_precision for r in df.collect()}


def test_selection_equals_the_cross_validator(rows):
    names = ["logistic_regression", "gbt", "decision_tree"]
    got = _aps(TR.model_selection(rows, FEATURES, algorithms=names, k=3))
    assert list(got) and set(got) == set(names)
    data = TR.assembler(FEATURES).transform(rows)
    for name, est in (("logistic_regression", TR.LogisticRegression(labelCol="Class", maxIter=50)),
                      ("decision_tree", TR.DecisionTreeClassifier(labelCol="Class", maxDepth=5, seed=42))):
        cv = CrossValidator(estimator=est, estimatorParamMaps=ParamGridBuilder().build(), evaluator=TR.APEvaluator("Class"), foldCol="fold", numFolds=3)
        assert got[name] == pytest.approx(cv.fit(data).avgMetrics[0], abs=1e-9)


def test_selection_learns_trees_of_a_large_table_from_bins(rows, monkeypatch):
    names = ["gbt", "decision_tree", "random_forest"]
    want = _aps(TR.model_selection(rows, FEATURES, algorithms=names, k=3))
    monkeypatch.setattr(TR, "BINNED_ROWS", 200)
    made, real = [], TR.binned
    monkeypatch.setattr(TR, "binned", lambda *args: made.append(real(*args)) or made[-1])
    monkeypatch.setattr(TR, "assembler", lambda _: None)  # rows are not learnt from one by one
    got = _aps(TR.model_selection(rows, FEATURES, algorithms=names, k=3))
    # one table to learn from and one to judge by for each fold, whatever the algorithms
    assert len(made) == 6 and sum(t.agg(F.sum("_n")).first()[0] for t in made) == 3 * rows.count()
    assert got["gbt"] == pytest.approx(want["gbt"], abs=1e-9) and got["decision_tree"] == pytest.approx(want["decision_tree"], abs=1e-9)
    assert got["random_forest"] == pytest.approx(want["random_forest"], abs=0.03)  # draws other rows


def test_selection_wants_every_fold(rows):
    with pytest.raises(ValueError, match="Folds must be 0 to 3"):
        TR.model_selection(rows, FEATURES, k=4)


def test_search_sums_a_large_table_once(rows, monkeypatch):
    space, base = {"maxDepth": ("choice", [2, 3]), "stepSize": ("uniform", 0.1, 0.5)}, {"maxIter": 4, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    split = rows.where("NOT is_val").drop("is_val"), rows.where("is_val").drop("is_val")
    want = {r.trial: r for r in TR.random_search(*split, FEATURES, space, n_trials=4, base=base).collect()}
    monkeypatch.setattr(TR, "BINNED_ROWS", 200)
    made, real = [], TR.binned
    monkeypatch.setattr(TR, "binned", lambda *args: made.append(real(*args)) or made[-1])
    got = {r.trial: r for r in TR.random_search(*split, FEATURES, space, n_trials=4, base=base).collect()}
    assert len(made) == 1 and made[0].agg(F.sum("_n")).first()[0] == rows.count()
    assert set(got) == set(want) == set(range(4))
    for k, r in want.items():
        assert got[k].params == r.params
        assert got[k].average_precision == pytest.approx(r.average_precision, abs=1e-9) and got[k].roc_auc == pytest.approx(r.roc_auc, abs=1e-9)
