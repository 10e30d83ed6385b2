"""A large table is boosted as one row for each bin: the same trees, every row counted, folds at once."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import train as TR

FEATURES = ["a", "b"]
WHOLE = {"maxDepth": 3, "stepSize": 0.3, "maxIter": 6, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 3000
    a, b = rng.integers(0, 20, n) / 4, rng.integers(0, 9, n) * 10.0
    y = (a + b / 20 + rng.normal(scale=1.0, size=n) > 5).astype(int)
    data = [(f"k{i}", float(a[i]), float(b[i]), int(y[i]), bool(i % 4 == 0), int(i % 3), 2.5 if y[i] else 1.0) for i in range(n)]
    return spark.createDataFrame(data, "k string, a double, b double, Class int, is_val boolean, fold int, weight double").checkpoint()


def _scores(model, rows):
    return {r.k: r.p_hat for r in TR.score(model, rows, ["k"]).collect()}


def test_bins_give_the_trees_of_the_rows(spark, rows, monkeypatch):
    made, real = [], TR.binned
    monkeypatch.setattr(TR, "binned", lambda *args: made.append(real(*args)) or made[-1])
    want = TR.fit(rows, FEATURES, TR.gbt(WHOLE))
    assert not made
    monkeypatch.setattr(TR, "BINNED_ROWS", 400)
    got = TR.fit(rows, FEATURES, TR.gbt(WHOLE))
    assert made[0].count() < rows.count() / 3 and made[0].agg(F.sum("_n")).first()[0] == rows.count()
    assert made[0].agg(F.sum("_w")).first()[0] == pytest.approx(rows.agg(F.sum("weight")).first()[0])
    a, b = _scores(want.model, rows), _scores(got.model, rows)
    assert len(a) == 3000 and b == pytest.approx(a, abs=1e-9)
    assert got.model.stages[-1].getNumTrees == want.model.stages[-1].getNumTrees
    lost = rows.limit(20).withColumn("a", F.when(F.col("k") != "k0", F.lit(float("nan")))).withColumn("b", F.lit(None).cast("double"))
    assert _scores(got.model, lost) == pytest.approx(_scores(want.model, lost), abs=1e-9)
    with pytest.raises(ValueError, match="missing"):
        TR.fit(rows.withColumn("a", F.nullif("a", F.lit(1.0))), FEATURES, TR.gbt(WHOLE))


def test_patience_on_bins(spark, rows, monkeypatch):
    want = TR.fit_with_patience(rows, FEATURES, WHOLE, patience=3, first_rounds=3)
    monkeypatch.setattr(TR, "BINNED_ROWS", 400)
    monkeypatch.setattr(TR, "assembler", None)  # rows are not boosted one by one
    got = TR.fit_with_patience(rows, FEATURES, WHOLE, patience=3, first_rounds=3)
    ap = [[r.average_precision for r in p.rounds.orderBy("round").collect()] for p in (want, got)]
    assert ap[1] == pytest.approx(ap[0], abs=1e-9) and got.best_round == want.best_round
    assert _scores(got.result.model, rows) == pytest.approx(_scores(want.result.model, rows), abs=1e-9)


def test_rows_are_not_summed_where_a_node_needs_so_many(spark, rows, monkeypatch):
    monkeypatch.setattr(TR, "BINNED_ROWS", 400)
    monkeypatch.setattr(TR, "binned", None)
    TR.fit(rows, FEATURES, TR.gbt({"maxDepth": 2, "maxIter": 1}, variant="lgbm"))


def test_few_bins_keep_several_rows_to_draw_from(spark, rows, monkeypatch):
    monkeypatch.setattr(TR, "BINNED_ROWS", 400)
    one = rows.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(2.0))
    t = TR.binned(one, TR.binning(one, FEATURES, 32), ["Class"])
    assert 100 < t.count() <= 450 and t.agg(F.sum("_n")).first()[0] == 3000


def test_many_valued_features_are_cut_evenly(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).cast("double").alias("a"), (F.col("id") % 4).cast("double").alias("b"))
    stages = TR.binning(df, FEATURES, 32)
    sizes = [r["count"] for r in stages[0].transform(df).groupBy("_bin_a").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 1.3 * 20000 / 32
    assert "nominal" not in str(TR.PipelineModel(stages).transform(df).schema["features"].metadata)


def test_folds_of_a_large_table_are_fitted_at_once(spark, rows, monkeypatch):
    monkeypatch.setattr(TR, "BINNED_ROWS", 400)
    together, real = threading.Barrier(3, timeout=120), TR.fit

    def fit(*args):
        together.wait()  # breaks unless three folds are under way
        return real(*args)

    monkeypatch.setattr(TR, "fit", fit)
    res, models = TR.fold_scores(rows, FEATURES, k=3, params={**WHOLE, "maxIter": 2})
    assert len(models) == 3 and {r.fold for r in res.collect()} == {0, 1, 2}
    for f, m in enumerate(models):  # in the order of the folds
        alone = real(rows.where(F.col("fold") != f), FEATURES, TR.gbt({**WHOLE, "maxIter": 2}))
        assert m.model.stages[-1].getNumTrees == alone.model.stages[-1].getNumTrees
