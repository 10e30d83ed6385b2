import numpy as np
import pandas as pd
import pytest

from vigil.operators import drift as D


def _np_psi(ref, cur, bins=10):
    edges = np.quantile(ref, np.linspace(0, 1, bins + 1))
    edges[0], edges[-1] = -np.inf, np.inf
    edges = np.unique(edges)
    r, _ = np.histogram(ref, edges)
    c, _ = np.histogram(cur, edges)
    r, c = r / r.sum(), c / c.sum()
    r, c = np.clip(r, 1e-6, None), np.clip(c, 1e-6, None)
    r, c = r / r.sum(), c / c.sum()
    return float(np.sum((r - c) * np.log(r / c)))


def _np_ks(ref, cur):
    ref, cur = np.sort(ref), np.sort(cur)
    allv = np.concatenate([ref, cur])
    return float(np.max(np.abs(np.searchsorted(ref, allv, "right") / ref.size
                                - np.searchsorted(cur, allv, "right") / cur.size)))


def test_psi_ks_match_numpy_with_ties(spark):
    rng = np.random.default_rng(7)
    ref = pd.DataFrame({"a": np.round(rng.normal(size=800), 1), "b": rng.integers(0, 5, 800).astype(float)})
    cur = pd.DataFrame({"a": np.round(rng.normal(0.3, 1.2, size=600), 1), "b": rng.integers(1, 6, 600).astype(float)})
    rep = D.drift_report(spark.createDataFrame(ref), spark.createDataFrame(cur),
                         D.DriftConfig(label_column="Class")).toPandas().set_index("feature")
    for f in ["a", "b"]:
        assert rep.loc[f, "psi"] == pytest.approx(_np_psi(ref[f].to_numpy(), cur[f].to_numpy()), abs=1e-9)
        assert rep.loc[f, "ks"] == pytest.approx(_np_ks(ref[f].to_numpy(), cur[f].to_numpy()), abs=1e-12)


def test_metric_map_keys_and_unknown_method(spark):
    ref = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (3.0, 4.0)], "a double, b double")
    cur = spark.createDataFrame([(1.5, 2.5), (2.5, 3.5), (3.5, 4.5)], "a double, b double")
    keys = {r["metric"] for r in D.drift_metric_map(ref, cur, "psi", bins=3).collect()}
    assert keys == {"drift.psi.a", "drift.psi.b"}
    with pytest.raises(ValueError):
        D.drift_metric_map(ref, cur, "chi2")
    with pytest.raises(ValueError):
        D.psi_edges(ref, bins=1)


def test_zero_thresholds_detect_drift(spark):
    ref = spark.createDataFrame([(1.0, 10.0, 0), (2.0, 20.0, 1), (3.0, 30.0, 0)], "Time double, Amount double, Class int")
    cur = spark.createDataFrame([(4.0, 40.0, 0), (5.0, 50.0, 1), (6.0, 60.0, 0)], "Time double, Amount double, Class int")
    cfg = D.DriftConfig(psi_threshold=0.0, ks_threshold=0.0)
    s = D.drift_summary(D.drift_report(ref, cur, cfg), cfg).first()
    assert s["drift_detected"] and s["feature_count"] == 2
    logged = {r["key"] for r in D.drift_log_metrics(D.drift_summary(D.drift_report(ref, cur, cfg), cfg)).collect()}
    assert "drift.detected" in logged and len(logged) == 7


def test_empty_side_gives_null_and_no_exceed(spark):
    ref = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    cur = spark.createDataFrame([(1.0, 3.0), (5.0, 4.0)], "a double, b double")
    rep = {r["feature"]: r for r in D.drift_report(ref, cur).collect()}
    assert rep["b"]["psi"] is None and rep["b"]["ks"] is None
    assert rep["b"]["psi_exceeds"] is False
