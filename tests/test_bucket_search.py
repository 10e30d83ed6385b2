"""A row's bucket is found by halving, not by looking at every bound."""

import math

import pytest
from pyspark.sql import functions as F

from vigil.operators import primitives as P
from vigil.operators import split as S

BOUNDS = [-3.5, 0.0, 1.0, 1.5, 40.0]
VALUES = [None, -math.inf, -4.0, -3.5, -1.0, 0.0, 0.5, 1.0, 1.2, 1.5, 39.0, 40.0, 41.0, math.inf, math.nan]


@pytest.mark.parametrize("bounds", [BOUNDS, [2.0], [], [0.0, math.inf]])
@pytest.mark.parametrize("descending", [False, True])
def test_buckets_are_monotone_and_bounds_stand_alone(spark, bounds, descending):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v double")
    lists = df.withColumn("_bs", F.array(*map(F.lit, bounds)).cast("array<double>"))
    for got in (P._in_buckets(df, "v", bounds, descending, "b"), lists.withColumn("b", P._value_bucket("v", "_bs", descending))):
        b = {r.i: r.b for r in got.collect()}
        places = [b[i] for i in range(len(VALUES))]
        # VALUES ascend in Spark's order with NULL first; descending order has NULL last
        order = list(reversed(places[1:])) + places[:1] if descending else places
        assert order == sorted(order) and (places[0] not in places[1:])
        for i, v in enumerate(VALUES):
            if v in bounds:
                assert places.count(places[i]) == 1
        assert bounds != BOUNDS or len(set(places)) >= 12


def test_ranks_by_key_look_at_no_list_of_bounds(spark, monkeypatch):
    monkeypatch.setattr(P, "MIN_BUCKET_ROWS", 50)
    monkeypatch.setattr(P, "shuffle_partitions", lambda *_: 64)
    df = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 10 == 0).cast("int").alias("Class"))
    for got, group in ((P.global_rank(df, "k"), None), (P.global_rank(df, "k", group="Class"), "Class")):
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "lambdafunction" not in plan and "_bounds" not in plan
        rows = got.collect()
        for c in {r.Class for r in rows} if group else {None}:
            mine = sorted((r for r in rows if c is None or r.Class == c), key=lambda r: r.k)
            assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
    b = S.batches(df, "k", 200).groupBy("batch_id").count().collect()
    assert len(b) == 15 and all(r["count"] == 200 for r in b)
