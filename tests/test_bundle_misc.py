from pyspark.sql import functions as F

from vigil.operators import scale as SC
from vigil.operators import split as SP
from vigil.operators import train as TR
from vigil.sources import files as IO


def test_resolve_scalers_prefers_metadata(spark):
    params = spark.createDataFrame([
        ("Amount", "amount_scaler", 1.0, 2.0), ("Amount", "custom_amt", 5.0, 6.0), ("Time", "scaler_time", 3.0, 4.0)],
        "column string, name string, center double, scale double")
    got = {r["column"]: (r["center"], r["scale"]) for r in SC.resolve_scalers(params, {"amount": "custom_amt"}).collect()}
    assert got == {"Amount": (5.0, 6.0), "Time": (3.0, 4.0)}


def test_permute_within_is_a_bijection_per_group(spark):
    df = spark.createDataFrame([(f"k{i}", i % 3, float(i)) for i in range(60)], "k string, g int, v double")
    p = SP.permute_within(df, "k", "g", "v", repeat=1)
    a = df.groupBy("g").agg(F.sort_array(F.collect_list("v")).alias("a"))
    b = p.groupBy("g").agg(F.sort_array(F.collect_list("v")).alias("a"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert p.join(df.withColumnRenamed("v", "v0"), ["k", "g"]).where(F.col("v") != F.col("v0")).count() > 0


def test_bundle_and_run_record(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(40)], "x double, Class int")
    r = TR.fit(df, ["x"], TR.gbt({"maxIter": 3, "maxDepth": 2}, weight=None, validation=None))
    md = TR.save_bundle(r, str(tmp_path / "bundle"), {"framework": "spark-gbt", "best_iteration": 3})
    keys = {row["key"] for row in md.collect()}
    assert {"features", "label_column", "framework"} <= keys
    runs, params, metrics = TR.run_record("run-1", "exp", {"maxIter": 3}, {"ap": 0.5, "auc": None}, {"t": "v"})
    assert metrics.count() == 1 and runs.first()["status"] == "FINISHED" and params.count() == 1
    logged = IO.log_metrics(spark.createDataFrame([("a", 1.0), ("b", None)], "key string, value double"),
                            "run-1", str(tmp_path / "metrics"))
    assert logged.count() == 1
