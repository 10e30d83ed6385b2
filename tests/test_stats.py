import numpy as np
import pandas as pd
import pytest

from vigil.operators import stats as S


def _frame(spark, seed=3, n=400):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"x": np.round(rng.gamma(2.0, 50.0, n), 2), "Class": (rng.random(n) < 0.1).astype(int)})
    return pdf, spark.createDataFrame(pdf)


def test_kernel_density_matches_numpy(spark):
    pdf, df = _frame(spark)
    x = pdf["x"].to_numpy()
    h = x.std(ddof=1) * len(x) ** (-1 / 5)
    grid = np.linspace(x.min(), x.max(), 20)
    want = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    got = S.kernel_density(df, "x", 20).toPandas().sort_values("point")
    assert np.allclose(got["x"], grid) and np.allclose(got["density"], want, rtol=1e-9)


def test_qcut_matches_pandas(spark):
    pdf, df = _frame(spark)
    want = pd.qcut(pdf["x"], q=10, duplicates="drop", labels=False).to_numpy()
    got = S.qcut(df, "x", 10).toPandas()
    m = got.sort_values("x")["bin"].to_numpy()
    # bins are monotone in x, so in x order they must equal pandas' sorted bins
    assert (np.sort(want) == m).all()


def test_histogram_matches_numpy(spark):
    pdf, df = _frame(spark)
    counts, _ = np.histogram(pdf["x"], bins=10)
    got = S.histogram(df, "x", 10).toPandas().sort_values("bin")
    assert got["n"].tolist() == counts.tolist()
    assert got["density"].to_numpy() == pytest.approx(counts / (len(pdf) * (pdf["x"].max() - pdf["x"].min()) / 10))


def test_value_counts_and_describe(spark):
    pdf, df = _frame(spark)
    vc = {r["Class"]: (r["count"], r["percentage"]) for r in S.value_counts(df, "Class").collect()}
    n1 = int(pdf["Class"].sum())
    assert vc[1] == (n1, round(n1 / len(pdf) * 100, 2))
    d = S.describe(df, ["x"]).first()
    q = np.quantile(pdf["x"], [0.25, 0.5, 0.75])
    assert (d["q25"], d["q50"], d["q75"]) == pytest.approx(tuple(q))
    assert d["std"] == pytest.approx(pdf["x"].std())


def test_projections_equal_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + [5, 0, -2, 1]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(300, 1.0, None, 2.0, 3.0)], "i int, a double, b double, c double, d double")
    feats = list("abcd")
    for p, m in ((S.pca(df, feats, 3), x - x.mean(axis=0)), (S.truncated_svd(df, feats, 3), x)):
        _, sv, vt = np.linalg.svd(m, full_matrices=False)
        vt = vt[:3] * np.sign(vt[np.arange(3), np.abs(vt[:3]).argmax(axis=1)])[:, None]
        want = sv[:3] if m is x else sv[:3] ** 2 / (sv ** 2).sum()
        assert np.allclose(p.values, want, rtol=1e-9)
        got = p.rows(df).orderBy("i").collect()
        assert np.allclose([[r.pc1, r.pc2, r.pc3] for r in got[:300]], m @ vt.T, atol=1e-8)
        assert got[300].pc1 is None and got[300].a == 1.0
