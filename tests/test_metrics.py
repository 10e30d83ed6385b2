import numpy as np
import pandas as pd
import pytest

from vigil.operators import metrics as M


def _brute_ap(y, p):
    order = np.argsort(-p, kind="mergesort")
    ys, ps = y[order], p[order]
    ap, tp, P = 0.0, 0, y.sum()
    i = 0
    while i < len(ps):
        j = i
        while j < len(ps) and ps[j] == ps[i]:
            j += 1
        tp += ys[i:j].sum()
        ap += ys[i:j].sum() * tp / j
        i = j
    return ap / P


def _brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    s = sum((neg < a).sum() + 0.5 * (neg == a).sum() for a in pos)
    return s / (len(pos) * len(neg))


def test_ap_auc_match_brute_force_with_ties(spark):
    rng = np.random.default_rng(5)
    p = np.round(rng.random(700), 1)
    y = (rng.random(700) < 0.2 + 0.5 * p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"Class": y, "score": p}))
    c = M.curve(df)
    assert M.average_precision(c).first()[0] == pytest.approx(_brute_ap(y, p), abs=1e-12)
    assert M.roc_auc(c).first()[0] == pytest.approx(_brute_auc(y, p), abs=1e-12)


def test_auc_null_without_positives(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.9)], "Class int, score double")
    c = M.curve(df)
    assert M.roc_auc(c).first()[0] is None
    assert M.average_precision(c).first()[0] is None


def test_basic_metrics_and_report(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (1, 1, 0.9), (0, 0, 0.2), (1, 1, 0.8)], "Class int, pred int, score double")
    k = M.confusion_counts(df, "Class", "pred")
    b = M.basic_metrics(k).first()
    assert (b["accuracy"], b["precision"], b["recall"], b["f1"]) == (1.0, 1.0, 1.0, 1.0)
    cm = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_long(k).collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 2}
    rep = {r["label"]: r for r in M.classification_report(k).collect()}
    assert rep["macro avg"]["f1_score"] == 1.0 and rep["1"]["support"] == 2.0


def test_topk_table_caps_k(spark):
    df = spark.createDataFrame([(f"k{i}", i % 2, i / 10) for i in range(10)], "txn_id string, Class int, score double")
    t = {r["k_req"]: r for r in M.topk_table(df, [3, 50]).collect()}
    assert t[50]["alerts_k"] == 10 and t[50]["tp"] == 5
    assert t[3]["tp"] == 2 and t[3]["fp"] == 1


def test_best_f1_prefers_lowest_threshold_on_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "Class int, score double")
    b = M.best_f1_threshold(M.curve(df)).first()
    assert b["threshold"] == pytest.approx(0.7)
