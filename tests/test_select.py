"""Selection: exact quantiles and hash cuts against numpy and sorting, with every refinement forced."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.functions.schema import extract_row_id
from vigil.operators import metrics as met
from vigil.operators import select as S
from vigil.operators import split as SP

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("finish, sketch", [(100_000, 2000), (5, 2000), (3, 20), (1, 4)])
def test_quantiles_match_numpy(spark, monkeypatch, finish, sketch):
    monkeypatch.setattr(S, "FINISH_ROWS", finish)
    monkeypatch.setattr(S, "SKETCH", sketch)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=500), np.full(300, 1.5), rng.integers(0, 4, 200), [-1e300, 1e300, 7.0]])
    pdf = pd.DataFrame({"feature": ["a"] * 600 + ["b"] * 400 + ["c"] * 2 + [None], "value": x})
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([("a", None), ("a", float("nan")), ("d", None)], "feature string, value double"))
    got = S.exact_quantiles(df.repartition(5), PROBS).toPandas()
    assert set(got.feature.dropna()) == {"a", "b", "c"} and got.feature.isna().sum() == len(PROBS)
    for f, sub in pdf.groupby("feature", dropna=False):
        mine = got[got.feature.isna() if f is None or f != f else got.feature == f].sort_values("prob")
        assert np.allclose(mine.q.to_numpy(), np.quantile(sub.value.to_numpy(), PROBS), rtol=1e-12, atol=1e-12), f
    if finish < 100_000:
        assert S.LEVELS  # pivots were used


def test_levels_shrink_fast(spark, monkeypatch):
    monkeypatch.setattr(S, "FINISH_ROWS", 50)
    df = spark.range(200_000).select(F.lit("x").alias("feature"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(5)).alias("value"))
    got = [r.q for r in S.exact_quantiles(df, PROBS).orderBy("prob").collect()]
    assert np.allclose(got, np.quantile(df.toPandas().value, PROBS), rtol=0, atol=1e-15)
    assert len(S.LEVELS) <= 3 and S.LEVELS[0][1] < 2000


@pytest.mark.parametrize("hashes", [2000, 3])
def test_cuts_give_exact_sizes(spark, monkeypatch, hashes):
    monkeypatch.setattr(S, "HASHES", hashes)
    pdf = pd.DataFrame({"k": [f"t{i}" for i in range(3000)], "c": [None if i % 50 == 0 else int(i % 10 == 0) for i in range(3000)]})
    df = spark.createDataFrame([(k, None if c != c else int(c)) for k, c in pdf.itertuples(index=False)], "k string, c int").withColumn("h", F.md5("k"))
    want = {0: 700, 1: 11, None: 59}
    counts, cuts = S.hash_cuts(df, "h", "c", lambda n: want)
    rows = df.collect()
    assert sum(counts.values()) == 3000
    for c, k in want.items():
        assert sorted(r.h for r in rows if r.c == c)[:k] == sorted(r.h for r in rows if r.c == c and r.h <= cuts[c])


def test_shared_keys_are_ranked(spark, monkeypatch):
    monkeypatch.setattr(S, "HASHES", 3)
    df = spark.createDataFrame([("same", 0)] * 40 + [("a", 1), ("b", 1), ("c", 1), ("d", 1)], "k string, Class int")
    m, sizes = SP.mark_split(df, "k", test=0.25)
    assert sizes == {0: 10, 1: 1} and m.where("is_test").count() == 11


def test_samples_and_splits_shuffle_nothing(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 20 == 0).cast("int").alias("Class"))
    for out in (SP.mark_split(df, "k")[0], SP.three_way_split(df, "k"), SP.undersample(df, "k")):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert SP.undersample(df, "k").groupBy("Class").count().collect()[0]["count"] == 250


def test_missing_scores_claim_nothing(spark):
    rows = [(1, .9), (0, .8), (1, .3), (0, .1), (1, None)]
    c = met.curve(spark.createDataFrame(rows, "Class int, score double"))
    assert [r.recall for r in met.pr_curve(c).where("threshold is not null").collect()] == [None] * 4
    assert met.best_f1_threshold(c).first().threshold is None
    assert tuple(met.recall_at_precision(c).first()) == (None, None, None, None)
    df = spark.createDataFrame([(y, p, int((p or 0) >= .5)) for y, p in rows], "Class int, score double, pred int")
    bins = met.calibration(df, n_bins=2).orderBy("bin").collect()
    assert [(r.bin, r.n, r.frac_pos) for r in bins] == [(0, 2, 0.5), (1, 2, 0.5)]
    got = {r.metric: r.value for r in met.canonical_metrics(df).collect()}
    assert all((got[m] is None) == any(x in m for x in ("AUC", "average_precision", "log_loss")) for m in got)
    rep = met.report_at_threshold(df, F.lit(0.5)).collect()
    assert all(r.precision is None and r.support is not None for r in rep)
    rep = met.report_at_threshold(df.where("score is not null"), F.lit(None).cast("double")).collect()
    assert all(r.f1_score is None for r in rep)
    by_hand = met.best_f1_threshold(met.curve(df.where("score is not null"))).first()
    assert by_hand.threshold == 0.3 and by_hand.f1 == pytest.approx(0.8)


def test_reversed_curve_equals_negated_scores(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(int(y), float(p)) for y, p in zip(rng.integers(0, 2, 400), rng.integers(0, 25, 400))], "Class int, score double")
    c = met.curve(df)
    neg = met.average_precision(met.curve(df.withColumn("score", -F.col("score")))).first()[0]
    assert met.average_precision_reversed(c).first()[0] == pytest.approx(neg, abs=1e-12)
    other = met.average_precision(met.curve(df.select((1 - F.col("Class")).alias("Class"), (-F.col("score")).alias("score")))).first()[0]
    assert met.average_precision_reversed(c, flip_labels=True).first()[0] == pytest.approx(other, abs=1e-12)


def test_row_id_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "id int, row_id int, x double")
    out, name = extract_row_id(df, ["id", "row_id"])
    assert name == "_row_id" and out.first().asDict() == {"_row_id": 1, "row_id": 2, "x": 3.0}


def test_rows_without_a_group_are_permuted(spark):
    df = spark.createDataFrame([(str(i), ["a", "b", None][i % 3], i) for i in range(30)], "k string, g string, x int")
    out = SP.permute_within(df, "k", "g", "x", 0).collect()
    for g in ("a", "b", None):
        assert sorted(r.x for r in out if r.g == g) == [i for i in range(30) if ["a", "b", None][i % 3] == g]
