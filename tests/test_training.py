"""Training that is really run: patience on AP, the search, folds, permutation importance."""

import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import metrics as met
from vigil.operators import train as TR

FEATURES = ["a", "b", "noise"]
SMALL = {"maxDepth": 2, "stepSize": 0.3, "maxIter": 24}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    n = 600
    a, b, noise = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    y = (a + 0.5 * b + rng.normal(scale=0.8, size=n) > 0.9).astype(int)
    data = [(f"k{i}", float(a[i]), float(b[i]), float(noise[i]), int(y[i]), bool(i % 3 == 0), int(i % 2), 1.0) for i in range(n)]
    return spark.createDataFrame(data, "k string, a double, b double, noise double, Class int, is_val boolean, fold int, weight double").checkpoint()


def by_round(rows, n):
    """Validation AP of fits with 1, 2, ... n rounds, each on its own."""
    out = []
    for r in range(1, n + 1):
        m = TR.fit(rows.where("NOT is_val"), FEATURES, TR.gbt({**SMALL, "maxIter": r}, validation=None))
        out.append(TR.evaluate(TR.score(m.model, rows.where("is_val"), ["Class"])).first()["average_precision"])
    return out


def test_patience_equals_round_by_round_fits(spark, rows, monkeypatch):
    monkeypatch.setattr(TR, "STAGED", 4)
    got = TR.fit_with_patience(rows, FEATURES, SMALL, patience=3, first_rounds=4)
    seen = [r.average_precision for r in got.rounds.orderBy("round").collect()]
    want = by_round(rows, 8)
    assert seen[:8] == pytest.approx(want[: len(seen)], abs=1e-12)
    best = max(range(len(seen)), key=lambda k: (seen[k], -k)) + 1
    assert got.best_round == best and got.result.model.stages[-1].getNumTrees == best
    # it ended when patience ran out (looked at in steps of four), or at the most rounds
    assert len(seen) == 24 or best + 3 <= len(seen) < best + 3 + 4
    ap = TR.evaluate(TR.score(got.result.model, rows.where("is_val"), ["Class"])).first()["average_precision"]
    assert ap == pytest.approx(seen[best - 1], abs=1e-12)


def test_search_runs_trials_at_once_and_ends(spark, rows, monkeypatch):
    running, most, lock, real = [0], [0], threading.Lock(), TR.fit

    def fit(*args):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.5)
        try:
            return real(*args)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(TR, "fit", fit)
    space = {"maxDepth": ("choice", [1, 2]), "stepSize": ("uniform", 0.1, 0.5)}
    split = rows.where("NOT is_val").drop("is_val"), rows.where("is_val")
    got = TR.random_search(*split, FEATURES, space, n_trials=4, base={"maxIter": 3}).collect()
    assert sorted(r.trial for r in got) == [0, 1, 2, 3] and 1 < most[0] <= 3
    assert [r.average_precision for r in got] == sorted((r.average_precision for r in got), reverse=True)
    # the same trial on its own
    k = got[0].trial
    drawn = TR.sample_grid(space, 4, 42)[k]
    m = real(rows, FEATURES, TR.gbt({"maxIter": 3, **drawn}))
    assert got[0].average_precision == pytest.approx(TR.evaluate(TR.score(m.model, split[1], ["Class"])).first()["average_precision"], abs=0.02)
    assert TR.random_search(*split, FEATURES, space, n_trials=50, base={"maxIter": 2}, time_limit=0.0).collect() == []


def test_folds_have_their_own_weight_and_importance(spark, rows, monkeypatch):
    seen, real = [], TR.fit

    def fit(train, *args):
        seen.append({r.Class: r.weight for r in train.select("Class", "weight").distinct().collect()})
        return real(train, *args)

    monkeypatch.setattr(TR, "fit", fit)
    marked = rows.withColumn("is_val", F.col("is_val") & (F.col("k") > "k3"))
    res, models = TR.fold_scores(marked, FEATURES, k=2, params={"maxDepth": 2, "maxIter": 4})
    assert res.count() == 2
    for f in (0, 1):
        n = {r.Class: r["count"] for r in marked.where((F.col("fold") != f) & ~F.col("is_val")).groupBy("Class").count().collect()}
        assert seen[f] == {0: 1.0, 1: pytest.approx(n[0] / n[1])}
    imp = TR.fold_permutation_importance(models, rows, "k", n_repeats=2)
    got = {(r.feature, r.fold): r.importance for r in imp.collect()}
    assert len(got) == 6 and all(got["a", f] > got["noise", f] for f in (0, 1))
    s = {r.feature: r for r in TR.fold_importance_summary(imp, top=2).collect()}
    assert s["a"]["rank"] == 1 and s["noise"].unstable_rank is None
    assert {s["a"].unstable_rank, s["b"].unstable_rank} == {1, 2}
    both = [got["a", 0], got["a", 1]]
    assert s["a"].mean_importance == pytest.approx(np.mean(both)) and s["a"].std_importance == pytest.approx(np.std(both, ddof=1))


def test_permutation_drop_by_hand(spark, rows):
    """The shuffled column of each repeat, made with Python, gives the same drops."""
    import hashlib
    m = TR.fit(rows, FEATURES, TR.gbt({"maxDepth": 2, "maxIter": 3}, validation=None)).model
    held = rows.where("is_val")
    drops = TR.permutation_drops({0: m}, held.withColumn("g", F.lit(0)), FEATURES, "k", "g", n_repeats=2)
    got = {(r["feature"], r["repeat"]): r["drop"] for r in drops.collect()}
    data = {r.k: r for r in held.collect()}

    def md5(*parts):
        return hashlib.md5(":".join(parts).encode()).hexdigest()

    order = sorted(data, key=lambda k: md5(k, "42", "perm-a"))

    def ap(values):
        df = spark.createDataFrame([(int(data[k].Class), *[float(v) for v in row]) for k, row in values.items()], "Class int, a double, b double, noise double")
        return met.average_precision(met.curve(TR.score(m, df, ["Class"]), "Class", "p_hat")).first()[0]

    base = ap({k: [data[k][f] for f in FEATURES] for k in data})
    other = sorted(data, key=lambda k: md5(k, "42", "perm-b", "1"))
    take = dict(zip(order, other))
    want = base - ap({k: [data[take[k]].a, data[k].b, data[k].noise] for k in data})
    assert got["a", 1] == pytest.approx(want, abs=1e-12)
