"""The rounds of a summed table: MLlib's trees without MLlib's jobs for each round."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from vigil.operators import boost as B
from vigil.operators import train as TR

FEATURES = ["a", "b", "c"]
WHOLE = {"maxDepth": 4, "stepSize": 0.3, "maxIter": 12, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 4000
    # c has more values than a tree has bins, so cuts are chosen at strides of the weight
    a, b, c = rng.integers(0, 20, n) / 4, rng.integers(0, 9, n) * 10.0, rng.integers(0, 45, n) * 1.0
    y = (a + b / 20 + c / 30 + rng.normal(scale=1.0, size=n) > 6).astype(int)
    data = [(f"k{i}", float(a[i]), float(b[i]), float(c[i]), int(y[i]), bool(i % 4 == 0), 2.5 if y[i] else 1.0) for i in range(n)]
    return spark.createDataFrame(data, "k string, a double, b double, c double, Class int, is_val boolean, weight double").checkpoint()


@pytest.fixture
def large(monkeypatch):
    monkeypatch.setattr(TR, "BINNED_ROWS", 400)


def _summed(rows, estimator):
    return TR._bins_of(rows, FEATURES, estimator, "Class")[1]


def _weighted(estimator):
    return estimator.copy({estimator.weightCol: "_w"})


@pytest.mark.parametrize("more", [{}, {"maxDepth": 6, "stepSize": 0.05}, {"maxDepth": 2, "minInfoGain": 0.002}, {"maxBins": 8}])
def test_trees_are_mllibs(rows, large, more):
    est = TR.gbt({**WHOLE, **more})
    table = _summed(rows, est)
    want, got = _weighted(est).fit(table), B.as_model(est, table, B.grow(est, table))
    assert got.getNumTrees == want.getNumTrees and got.treeWeights == want.treeWeights
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), rel=1e-6)
    scored = [{(r._bin_a, r._bin_b, r._bin_c): r.p_hat for r in TR.score(m, table, ["_bin_a", "_bin_b", "_bin_c"]).collect()} for m in (want, got)]
    assert scored[1] == pytest.approx(scored[0], abs=1e-9)
    for p in ("featuresCol", "labelCol", "maxDepth", "stepSize", "maxBins"):
        assert got.getOrDefault(p) == want.getOrDefault(p)


def test_a_large_table_needs_no_job_for_each_round(rows, large, monkeypatch):
    monkeypatch.setattr(GBTClassifier, "_fit", None)  # MLlib's rounds
    r = TR.fit(rows, FEATURES, TR.gbt(WHOLE))
    assert r.model.stages[-1].getNumTrees > 1
    split = rows.where("NOT is_val").drop("is_val"), rows.where("is_val").drop("is_val")
    got = TR.random_search(*split, FEATURES, {"stepSize": ("uniform", 0.1, 0.3)}, n_trials=2, base={**WHOLE, "maxIter": 3})
    assert {x.trial for x in got.collect()} == {0, 1}


def test_rounds_go_on_from_earlier_ones(rows, large):
    est = TR.gbt({"maxDepth": 3, "maxIter": 9}, validation=None)
    table = TR.binned(rows, TR.binning(rows, FEATURES, 32), ["Class"], "weight")
    first = B.grow(est.copy({est.maxIter: 4}), table)
    whole = B.grow(est, table)
    assert len(first) == 4 and B.grow(est, table, first) == whole and whole[:4] == first
    # another order and number of parts of the same rows
    again = B.grow(est, table.repartition(3, "_bin_c"))
    assert again == whole


def test_least_rows_of_a_node_are_counted_on_summed_rows(rows, large, monkeypatch):
    p = {**WHOLE, "maxDepth": 5, "maxIter": 4, "minInstancesPerNode": 60}
    monkeypatch.setattr(TR, "BINNED_ROWS", 10 ** 9)
    want = TR.fit_with_patience(rows, FEATURES, p, variant="lgbm", patience=3, first_rounds=2)
    made, real = [], TR.binned
    monkeypatch.setattr(TR, "binned", lambda *args: made.append(real(*args)) or made[-1])
    monkeypatch.setattr(TR, "BINNED_ROWS", 400)
    got = TR.fit_with_patience(rows, FEATURES, p, variant="lgbm", patience=3, first_rounds=2)
    ap = [[r.average_precision for r in x.rounds.orderBy("round").collect()] for x in (want, got)]
    assert len(made) == 2 and ap[1] == pytest.approx(ap[0], abs=1e-6) and got.best_round == want.best_round
    # beyond the size that one task holds the rows themselves are learnt from
    monkeypatch.setattr(B, "GROWN_ROWS", 10)
    rest = TR.fit_with_patience(rows, FEATURES, p, variant="lgbm", patience=3, first_rounds=2)
    assert [r.average_precision for r in rest.rounds.orderBy("round").collect()] == pytest.approx(ap[0], abs=1e-12)


def test_a_table_beyond_one_task_is_left_to_mllib(rows, large, monkeypatch):
    want = TR.fit(rows, FEATURES, TR.gbt(WHOLE)).model
    monkeypatch.setattr(B, "GROWN_ROWS", 10)
    monkeypatch.setattr(B, "grow", None)
    got = TR.fit(rows, FEATURES, TR.gbt(WHOLE)).model
    assert {r.k: r.p_hat for r in TR.score(got, rows, ["k"]).collect()} == pytest.approx({r.k: r.p_hat for r in TR.score(want, rows, ["k"]).collect()}, abs=1e-9)


def test_draws(rows, large):
    est = TR.gbt({"maxDepth": 3, "maxIter": 6}, validation=None)
    table = TR.binned(rows, TR.binning(rows, FEATURES, 32), ["Class"], "weight")
    trees = B.grow(est, table)
    whole = table.agg(F.sum("_w")).first()[0]
    shares = [t[0]["w"] / whole for t in trees]  # the weight that a tree's root has seen
    assert len(set(shares)) == 6 and all(0.7 < s < 0.9 for s in shares)
    assert [B.features_per_node(s, 5) for s in ("all", "auto", "0.8", "2", "sqrt", "onethird", "log2", "1.0")] == [5, 5, 4, 2, 3, 2, 3, 5]
    assert [B.features_per_node(s, 4) for s in ("0.8", "0.5", "9")] == [4, 2, 4]


def test_one_class_and_one_bin(spark, large):
    df = spark.range(500).select(F.lit(1.0).alias("a"), F.lit(2.0).alias("b"), F.lit(3.0).alias("c"), (F.col("id") % 5 == 0).cast("int").alias("Class"), F.lit(1.0).alias("weight"))
    for data in (df, df.withColumn("Class", F.lit(0))):
        r = TR.fit(data, FEATURES, TR.gbt({"maxIter": 3, "subsamplingRate": 1.0}, validation=None))
        p = TR.score(r.model, df.limit(1)).first().p_hat
        assert 0.0 < p < 0.5 and r.model.stages[-1].trees[0].numNodes == 1


def test_each_set_of_bins_is_scored_once(rows, large, monkeypatch):
    m = TR.fit(rows, FEATURES, TR.gbt(WHOLE)).model
    twice = rows.unionByName(rows).withColumn("a", F.when(F.col("k") != "k7", F.col("a")))
    sets = TR.PipelineModel(m.stages[:1]).transform(twice).select("_bin_a", "_bin_b", "_bin_c").distinct().count()

    def counts(df, n):
        return {(r.Class, r.p): r.n for r in df.groupBy("Class", F.round("p_hat", 12).alias("p")).agg(n.alias("n")).collect()}

    want, seen, real = counts(TR.score(m, twice, ["Class"]), F.count(F.lit(1))), [], B.probabilities
    monkeypatch.setattr(B, "probabilities", lambda model, df: seen.append(df.count()) or real(model, df))
    assert counts(TR.score_sums(m, twice, ["Class"]), F.sum("_n")) == want and sum(want.values()) == 8000 and seen == [sets]
    # a model that was not grown here goes through MLlib
    del m.stages[-1].grown
    assert counts(TR.score_sums(m, twice, ["Class"]), F.sum("_n")) == want and seen == [sets]


def test_missing_values_of_held_rows(rows, large):
    est = TR.gbt(WHOLE)
    table = _summed(rows.withColumn("c", F.when(F.col("is_val") & (F.col("b") < 20), F.lit(float("nan"))).otherwise(F.col("c"))), est)
    want, got = _weighted(est).fit(table), B.as_model(est, table, B.grow(est, table))
    assert got.getNumTrees == want.getNumTrees and got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), rel=1e-6)
    with pytest.raises(Exception, match="missing values"):
        B.grow(est, _summed(rows.withColumn("a", F.when(F.col("k") != "k0", F.col("a"))), est))


def test_permutation_and_folds_on_bins(spark, rows, monkeypatch):
    folds = rows.withColumn("fold", (F.substring("k", 2, 5).cast("int") % 2).cast("int"))
    monkeypatch.setattr(TR, "BINNED_ROWS", 400)
    res, models = TR.fold_scores(folds, FEATURES, k=2, params={**WHOLE, "maxIter": 4})
    drops = {(r.feature, r.fold): r.importance for r in TR.fold_permutation_importance(models, folds, "k", n_repeats=2).collect()}
    got = {r.fold: r.average_precision for r in res.collect()}
    monkeypatch.setattr(TR, "score_sums", lambda model, df, keep: TR.score(model, df, keep).withColumn("_n", F.lit(1).cast("long")))  # row by row
    assert {(r.feature, r.fold): r.importance for r in TR.fold_permutation_importance(models, folds, "k", n_repeats=2).collect()} == pytest.approx(drops, abs=1e-12)
    assert len(drops) == 6 and got == {f: pytest.approx(TR.evaluate(TR.score(m.model, folds.where(F.col("fold") == f), ["Class"])).first()["average_precision"], abs=1e-12)
                                       for f, m in enumerate(models)}
