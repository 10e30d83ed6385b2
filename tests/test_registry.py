import pytest
from pyspark.sql import functions as F

from vigil.functions import scalars as S
from vigil.operators import alerts as A
from vigil.operators import registry as R


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_metric_alias_and_direction(spark):
    m = _one(spark, S.normalize_metric(F.lit("AUC")))
    assert (m["bare"], m["full"], m["valid"]) == ("AUC_macro", "metrics.AUC_macro", True)
    assert _one(spark, S.normalize_metric(F.lit("f1")))["valid"] is False
    assert _one(spark, S.metric_direction(F.lit("log_loss"))) == "min"
    assert _one(spark, S.metric_direction(F.lit("AUC_macro"))) == "max"


def test_better_same_threshold(spark):
    assert _one(spark, R.is_better(F.lit(0.9), F.lit(0.85), F.lit("max"), delta=0.01)) is True
    assert _one(spark, R.is_better(F.lit(0.9), F.lit(0.895), F.lit("max"), delta=0.01)) is False
    assert _one(spark, R.is_same(F.lit(0.9), F.lit(0.9005), epsilon=0.001)) is True
    assert _one(spark, R.is_same(F.lit(0.9), F.lit(0.9005))) is False
    assert _one(spark, R.meets_min(F.lit(0.3), F.lit("min"), 0.5)) is True


def test_experiment_dedupe(spark):
    assert _one(spark, S.split_names(F.lit(" a, b ,a,, c"))) == ["a", "b", "c"]


def test_versions(spark):
    df = spark.createDataFrame([("m", v, i) for i, v in enumerate(["1.0", "1.2", "2.0", "x"])],
                               "name string, version string, asset_id int")
    assert R.next_versions(df).first()["next_version"] == "2.1"
    assert R.latest_versions(df).first()["version"] == "2.0"
    none = spark.createDataFrame([("m", "abc", 0)], "name string, version string, asset_id int")
    assert R.next_versions(none, base_version="1.0").first()["next_version"] == "1.0"
    three = spark.createDataFrame([("m", "1", 0), ("m", "3", 1)], "name string, version string, asset_id int")
    assert R.latest_versions(three).first()["version"] == "3"


def test_best_run_and_decision(spark):
    runs = spark.createDataFrame([("run-1", "exp", "FINISHED"), ("run-2", "exp", "FINISHED"), ("run-3", "exp", "FAILED")],
                                 "run_id string, experiment_name string, status string")
    rm = spark.createDataFrame([("run-1", "accuracy", 0.9), ("run-2", "accuracy", 0.95), ("run-3", "accuracy", 0.99)],
                               "run_id string, key string, value double")
    b = A.best_runs(runs, rm, ["accuracy"], "exp").first()
    assert (b["run_id"], b["metric_value"]) == ("run-2", 0.95)
    prod = spark.createDataFrame([("prod", "accuracy", 0.94), ("other", "accuracy", None)],
                                 "name string, metric string, prod_value double")
    best = A.best_runs(runs, rm, ["accuracy"], "exp")
    d = {r["name"]: (r["decision"], r["reason"]) for r in R.decide(best, prod, delta=0.005).collect()}
    assert d == {"prod": ("promote", "better_metric"), "other": ("promote", "no_prod_model")}
    with pytest.raises(ValueError):
        A.best_runs(runs, rm, ["not_a_metric"], "exp")
    for none in ("", " , ", []):
        with pytest.raises(ValueError, match="experiment"):
            A.best_runs(runs, rm, ["accuracy"], none)


def test_idempotency_key(spark):
    import hashlib
    want = hashlib.sha1("a::b::sha".encode()).hexdigest()[:7]
    assert _one(spark, S.idempotency_key([F.lit(" a "), F.lit(""), F.lit("b")], F.lit("sha"))) == want


def test_ledger_is_idempotent(spark, tmp_path):
    rows = [("brand", "AUC_macro", "max", "run-1", "automl_train", 0.9, "2.0", "run-0", 0.8, "promote", "better_metric", True, "brand"),
            ("other", "AUC_macro", "max", "run-1", "automl_train", 0.9, "1.0", "run-5", 0.9, "skip", "equal_metric", False, None),
            ("third", "AUC_macro", "max", "run-1", "automl_train", 0.9, "1.0", "run-6", 0.95, "stage", "worse_metric", False, "model_run-1")]
    d = spark.createDataFrame(rows, "name string, metric string, direction string, run_id string, experiment_name string, metric_value double, prod_version string, "
                                    "prod_run_id string, prod_value double, decision string, reason string, should_promote boolean, model_name string")
    versions = spark.createDataFrame([("brand", "2.1")], "name string, next_version string")
    path = f"{tmp_path}/ledger"
    dry = R.promotion_records(d, ["a", "b"], versions, git_sha="abc")
    assert dry.columns[:17] == R.RECORD_FIELDS and dry.where("tags IS NOT NULL OR model_version IS NOT NULL").count() == 0
    assert R.append_promotions(dry, path).count() == 0 and not (tmp_path / "ledger").exists()
    real = R.promotion_records(d, ["a", "b"], versions, dataset_version="d7", git_sha="abc", dry_run=False)
    assert sorted(r.model_id for r in R.append_promotions(real, path).collect()) == ["brand:2.1", "model_run-1:1"]
    assert R.append_promotions(real, path).count() == 0
    ledger = {r.model_name: r for r in spark.read.parquet(path).collect()}
    import hashlib
    key = hashlib.sha1("automl_train::AUC_macro::run-1::abc".encode()).hexdigest()[:7]
    assert set(ledger["brand"].tags) == set(R.TAG_KEYS) and {r.idempotency_key for r in ledger.values()} == {key}
    assert (ledger["brand"].tags["stage"], ledger["brand"].tags["dataset_version"], ledger["model_run-1"].tags["alias"]) == ("production", "d7", "staging")
    # equal metrics register only when forced; that model is in the ledger already
    forced = R.promotion_records(d.where("decision = 'skip'"), ["a"], versions, git_sha="abc", dry_run=False, force=True)
    assert forced.first().model_name == "model_run-1" and R.append_promotions(forced, path).count() == 0
    other = R.promotion_records(d.where("decision = 'skip'"), ["a"], versions, git_sha="new", dry_run=False, force=True)
    assert R.append_promotions(other, path).count() == 1 and spark.read.parquet(path).count() == 3
