"""Ranks by a text key make each key twice: to count its leading bytes and for the row itself; an evaluation reads its rows once."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import metrics as met
from vigil.operators import primitives as P
from vigil.plans import pipelines


def _counting(spark, name, f, kind):
    seen = spark.sparkContext.accumulator(0)

    def made(x):
        seen.add(1)
        return f(x)
    return seen, F.udf(made, kind)


@pytest.mark.parametrize("group", [None, "g"])
def test_a_text_key_is_made_twice(spark, tiny_buckets, group):
    import hashlib
    seen, key = _counting(spark, "k", lambda i: None if i == 7 else hashlib.md5(str(i).encode()).hexdigest(), "string")
    df = spark.range(2000).withColumn("g", F.when(F.col("id") % 10 > 0, F.col("id") % 3)).withColumn("k", key("id"))
    got = {r.id: r.r for r in P.global_rank(df, "k", group=group, rank_col="r").select("id", "r").collect()}
    assert seen.value <= 2 * 2000
    w = Window.partitionBy(group).orderBy("k") if group else Window.orderBy("k")
    assert got == {r.id: r.r for r in df.withColumn("r", F.row_number().over(w)).collect()}


def test_keys_with_one_long_lead_are_still_split(spark, tiny_buckets):
    df = spark.range(3000).withColumn("k", F.format_string("customer-é-%06d", (F.col("id") * 7919) % 3000))
    assert P._by_leads(df, [], "k") is None
    got = P.global_rank(df, "k", rank_col="r").withColumn("w", F.row_number().over(Window.orderBy("k")))
    assert got.count() == 3000 and got.where("r != w").count() == 0


def test_many_missing_scores_are_split_by_the_key(spark, tiny_buckets):
    df = spark.range(3000).withColumn("s", F.when(F.col("id") % 2 == 0, F.col("id").cast("double")))
    for desc in (True, False):
        got = P.global_rank(df, "id", order="s", descending=desc, rank_col="r")
        w = Window.orderBy(F.col("s").desc() if desc else F.col("s").asc(), "id")
        assert got.withColumn("w", F.row_number().over(w)).where("r != w").count() == 0


def test_an_evaluation_reads_its_rows_once(spark):
    seen, score = _counting(spark, "s", lambda i: (i % 40) / 40, "double")
    df = spark.range(1000).select((F.col("id") % 7 == 0).cast("int").alias("Class"), (F.col("id") % 3 == 0).cast("int").alias("pred"), score("id").alias("score"))
    got = {r.metric: r.value for r in pipelines.evaluate(df).collect()}
    assert seen.value <= 1000
    plain = met.basic_metrics(met.confusion_counts(df, "Class", "pred")).first()
    assert got["metrics.f1"] == plain["f1"] and got["metrics.accuracy"] == plain["accuracy"] and got["metrics.alert_count"] == plain["alert_count"]
    curve = met.curve(df)
    assert got["metrics.roc_auc"] == pytest.approx(met.roc_auc(curve).first()[0]) and got["metrics.pr_auc"] == pytest.approx(met.average_precision(curve).first()[0])


def test_many_groups_have_shorter_leads(spark, tiny_buckets, monkeypatch):
    monkeypatch.setattr(P, "MOST_LEADS", 400)
    df = spark.range(3000).withColumn("g", F.col("id") % 20).withColumn("k", F.md5(F.col("id").cast("string")))
    work, offsets = P._by_leads(df, ["g"], "k")
    assert offsets.count() <= 400 and work.where("octet_length(_b) >= 4").count() == 0
    got = P.global_rank(df, "k", group="g", rank_col="r").withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert got.count() == 3000 and got.where("r != w").count() == 0


def test_shuffled_copies_are_not_written(spark, monkeypatch):
    """Each row is written once for a repeat, not once more for every feature."""
    from vigil.operators import train as tr
    written = []
    monkeypatch.setattr(tr, "materialize", lambda df: (written.append(out := P.materialize(df)), out)[1])
    df = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 3 == 0).cast("int").alias("Class"),
                                 *[(F.col("id") % m).cast("double").alias(f"f{m}") for m in (3, 5, 7, 11)])
    features = ["f3", "f5", "f7", "f11"]
    monkeypatch.setattr(tr, "score", lambda model, rows, keep: rows.select(*keep, (-F.col("f3")).alias("p_hat")))
    got = {r.feature: r.importance_mean for r in tr.permutation_importance(None, df, features, "k", n_repeats=2).collect()}
    assert got["f3"] > 0.3 and got["f5"] == got["f7"] == got["f11"] == 0
    assert max(d.count() for d in written) <= 2 * 400
