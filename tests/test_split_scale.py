import pytest
from pyspark.sql import functions as F

from vigil.operators import scale as SC
from vigil.operators import split as SP


def _frame(spark, n=200):
    return spark.createDataFrame([(f"t{i}", float(i), float(i % 7), 1 if i % 10 == 0 else 0) for i in range(n)],
                                 "txn_id string, Amount double, Time double, Class int")


def test_exact_sizes_and_repartition_proof(spark):
    df = _frame(spark)
    m1, sizes = SP.mark_split(df, "txn_id", test=0.25)
    m2, _ = SP.mark_split(df.repartition(5), "txn_id", test=0.25)
    assert m1.where("is_test").count() == 50 == sum(sizes.values())
    a = {r["txn_id"] for r in m1.where("is_test").collect()}
    b = {r["txn_id"] for r in m2.where("is_test").collect()}
    assert a == b
    assert sizes == {0: 45, 1: 5}


def test_zero_test_and_errors(spark):
    df = _frame(spark)
    train, test = SP.split_data(df, "txn_id", test=0.0)
    assert test.count() == 0 and test.columns == df.columns
    with pytest.raises(ValueError):
        SP.split_data(df, "txn_id", test=1.0)
    with pytest.raises(ValueError):
        SP.split_data(df.drop("Class"), "txn_id")


def test_folds_balanced(spark):
    f = SP.stratified_kfold(_frame(spark), "txn_id", k=5)
    counts = {(r["fold"], r["Class"]): r["count"] for r in f.groupBy("fold", "Class").count().collect()}
    assert all(counts[(i, 1)] == 4 and counts[(i, 0)] == 36 for i in range(5))


def test_scalers_change_data_and_serving_check(spark):
    df = _frame(spark)
    p = SC.collect_params(SC.fit_scalers(df))
    assert p["Amount"] == (pytest.approx(99.5), pytest.approx(99.5))
    out = SC.transform_with_scalers(df, p)
    assert out.agg(F.max("Amount")).first()[0] == pytest.approx((199 - 99.5) / 99.5)
    with pytest.raises(ValueError):
        SC.apply_for_serving(df, {"Amount": p["Amount"]})
    w = SC.class_weight(df).first()
    assert w["weight"] == pytest.approx(180 / 20)
