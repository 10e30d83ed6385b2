"""The training table of the registered queries is dealt over all cores, however few parts its file has."""

from pyspark.sql import functions as F

from vigil.plans import queries as Q


def test_training_table_uses_every_core(spark, tmp_path, monkeypatch):
    t = Q.fx.transactions(spark, "/root/testdata/sf0.001").coalesce(1)
    monkeypatch.setattr(Q.fx, "transactions", lambda *_: t)
    train, test, _ = Q._training_setup(spark, str(tmp_path))
    cores = spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == cores and max(sizes) < 2 * sum(sizes) / cores
    assert sum(sizes) + test.count() == t.count()
    # no row is lost, doubled or marked otherwise
    assert train.select("txn_id").distinct().count() == sum(sizes)


def test_folds_use_every_core(spark, tmp_path, monkeypatch):
    t = Q.fx.transactions(spark, "/root/testdata/sf0.001").coalesce(1)
    monkeypatch.setattr(Q.fx, "transactions", lambda *_: t)
    seen = []
    monkeypatch.setattr(Q.tr, "model_selection", lambda folds, *_, **__: seen.append(folds))
    Q.QUERIES["model_selection"](spark, str(tmp_path))
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism
