"""Distributed rank / running sums / quantiles against brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import primitives as P


def _tied_frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    # one value holds a third of the rows, the rest are heavy ties and a tail
    v = np.where(rng.random(n) < 0.34, 0.5, np.round(rng.random(n), 2))
    v[rng.random(n) < 0.02] = np.nan
    pdf = pd.DataFrame({"i": np.arange(n), "v": v, "g": rng.integers(0, 3, n)})
    df = spark.createDataFrame(pdf).withColumn("k", F.md5(F.col("i").cast("string")))
    return df.withColumn("v", F.when(F.col("i") % 97 == 0, F.lit(None)).otherwise(F.col("v")))


def test_global_rank_matches_window(spark, tiny_buckets):
    df = _tied_frame(spark).repartition(7)
    for desc in (True, False):
        got = P.global_rank(df, "k", order="v", descending=desc, rank_col="r")
        o = F.col("v").desc() if desc else F.col("v").asc()
        want = df.withColumn("r2", F.row_number().over(Window.orderBy(o, "k")))
        bad = got.join(want, "i").where(F.col("r") != F.col("r2")).count()
        assert bad == 0
        assert got.count() == df.count()


def test_global_rank_grouped_key_only(spark, tiny_buckets):
    df = _tied_frame(spark)
    got = P.global_rank(df, "k", group="g", rank_col="r")
    want = df.withColumn("r2", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert got.join(want, "i").where(F.col("r") != F.col("r2")).count() == 0


def test_running_sums_match(spark, tiny_buckets):
    df = _tied_frame(spark).where(F.col("v").isNotNull() & ~F.isnan("v"))
    d = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    got = P.running_sums(d, "v", ["c"], group="g", descending=True).toPandas()
    pdf = d.toPandas().sort_values(["g", "v"], ascending=[True, False])
    pdf["want"] = pdf.groupby("g")["c"].cumsum()
    m = got.merge(pdf, on=["g", "v"])
    assert len(m) == len(pdf)
    assert (m["c_cum"] == m["want"]).all()


def test_rank_is_repartition_proof(spark, tiny_buckets):
    df = _tied_frame(spark)
    a = P.global_rank(df.repartition(1), "k", order="v", rank_col="r").select("i", "r")
    b = P.global_rank(df.repartition(5), "k", order="v", rank_col="r").select("i", F.col("r").alias("r5"))
    assert a.join(b, "i").where(F.col("r") != F.col("r5")).count() == 0


def test_refinement_paths_are_exercised(spark, tiny_buckets):
    P.LEVEL_LOG.clear()
    df = _tied_frame(spark)
    P.global_rank(df, "k", order="v", rank_col="r").count()
    kinds = {e[0] for e in P.LEVEL_LOG}
    assert "key" in kinds and 0 in kinds


KEYS = {
    "bigint": "i", "decimal text": "cast(i as string)", "T text": "format_string('T%05d', i)",
    "md5": "md5(cast(i as string))", "date": "date_add(date'2000-01-01', cast(i as int))",
}


def test_rank_is_the_same_for_every_key_and_size(spark):
    for n in (1000, 60000):
        for name, key in KEYS.items():
            df = spark.range(n).withColumnRenamed("id", "i").withColumn("k", F.expr(key)).withColumn("s", F.lit(0.5)).repartition(6)
            got = P.global_rank(df, "k", rank_col="r").join(P.global_rank(df, "k", order="s", rank_col="r3").select("i", "r3"), "i")
            want = df.withColumn("r2", F.row_number().over(Window.orderBy("k"))).select("i", "r2")
            assert got.join(want, "i").where("r != r2 OR r3 != r2").count() == 0, (n, name)


def test_null_groups_are_kept(spark, tiny_buckets):
    df = _tied_frame(spark).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = P.global_rank(df, "k", order="v", group="g", rank_col="r")
    want = df.withColumn("r2", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "k")))
    assert got.count() == df.count()
    assert got.join(want, "i").where("r != r2").count() == 0
