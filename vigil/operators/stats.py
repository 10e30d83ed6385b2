"""Exploratory statistics.

Columns are unpivoted once (``to_long``) so every statistic over many
features is one grouped job. Quantiles are exact order statistics, found by
selection, never a single-task buffer of all values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.scalars import is_missing
from vigil.operators.primitives import finite, to_long
from vigil.operators.select import edge_bin, exact_quantiles


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F1 (+F2 counts): column, count, null_count, mean, std, min, q25, q50, q75, max."""
    nulls = df.agg(*[F.count_if(is_missing(F.col(c), df.schema[c].dataType)).alias(c) for c in columns])
    nulls = nulls.unpivot([], list(columns), "column", "null_count")
    long = to_long(df, [], columns, feature_col="column")
    base = long.groupBy("column").agg(
        F.count(F.lit(1)).cast("long").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, [0.25, 0.5, 0.75], group="column")
    qw = q.groupBy("column").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("q"))
    qw = qw.select("column", F.col("`0.25`").alias("q25"), F.col("`0.5`").alias("q50"), F.col("`0.75`").alias("q75"))
    return (base.join(qw, "column", "left").join(nulls, "column", "left")
            .select("column", "count", F.col("null_count").cast("long").alias("null_count"), "mean", "std", "min",
                    "q25", "q50", "q75", "max"))


def max_null_count(df: DataFrame) -> DataFrame:
    """the largest per-column missing count, one row."""
    cols = df.columns
    k = df.agg(*[F.count_if(is_missing(F.col(f"`{c}`"), df.schema[c].dataType)).alias(f"_m{i}")
                 for i, c in enumerate(cols)])
    return k.select(F.greatest(*[F.col(f"_m{i}") for i in range(len(cols))]).cast("long").alias("max_null_count")) \
        if len(cols) > 1 else k.select(F.col("_m0").cast("long").alias("max_null_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, count, percentage (2 places) of all rows."""
    c = df.groupBy(column).agg(F.count(F.lit(1)).cast("long").alias("count"))
    tot = df.agg(F.count(F.lit(1))).scalar()
    return c.select(column, "count", F.round(F.col("count") / tot * 100, 2).alias("percentage"))


def class_summary(df: DataFrame, features: Sequence[str], label: str = "Class") -> DataFrame:
    """per (feature, label): mean, median, min, max, p95, p99."""
    long = to_long(df, [label], features)
    base = long.groupBy("feature", label).agg(F.avg("value").alias("mean"), F.min("value").alias("min"),
                                              F.max("value").alias("max"))
    q = exact_quantiles(long, [0.5, 0.95, 0.99], group=["feature", label])
    qw = q.groupBy("feature", label).pivot("prob", [0.5, 0.95, 0.99]).agg(F.first("q"))
    qw = qw.select("feature", label, F.col("`0.5`").alias("median"), F.col("`0.95`").alias("p95"),
                   F.col("`0.99`").alias("p99"))
    return base.join(qw, ["feature", label]).select("feature", label, "mean", "median", "min", "max", "p95", "p99")


def quantile_edges(df: DataFrame, column: str, q: int = 10) -> DataFrame:
    """F5 edges: one row (edges) with the distinct quantiles at linspace(0, 1, q+1)."""
    probs = [i / q for i in range(q + 1)]
    long = df.select(F.lit(column).alias("feature"), F.col(column).cast("double").alias("value"))
    e = exact_quantiles(long, probs)
    return e.agg(F.array_sort(F.array_distinct(F.collect_list("q"))).alias("edges"))


def qcut(df: DataFrame, column: str, q: int = 10, bin_col: str = "bin") -> DataFrame:
    """right-closed quantile bins (lowest edge included), duplicate edges
    dropped; adds ``bin`` and the bin's ``lo``/``hi`` edges."""
    e = quantile_edges(df, column, q).select("edges").scalar()  # one short array
    x = F.col(column)
    inner = F.slice("_edges", 2, F.greatest(F.size("_edges") - 2, F.lit(0)))
    b = edge_bin(x, inner, q - 1, closed=False)
    return (df.withColumn("_edges", e).withColumn(bin_col, b)
            .withColumn("lo", F.element_at("_edges", F.col(bin_col) + 1))
            .withColumn("hi", F.element_at("_edges", F.col(bin_col) + 2)).drop("_edges"))


def rate_by_bin(binned: DataFrame, label: str = "Class", bin_col: str = "bin") -> DataFrame:
    """rows and positive rate in percent per bin."""
    return binned.groupBy(bin_col, "lo", "hi").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                                   (F.avg(label) * 100).alias("rate_pct"))


def corr_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every column pair (a < b in the given order), one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    k = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{i}")
                 for i, (a, b) in enumerate(pairs)])
    return k.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                                F.col(f"_r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])))


def target_corr(df: DataFrame, features: Sequence[str], target: str = "Class") -> DataFrame:
    """F8: r of each feature with the target (NULL when undefined)."""
    k = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f"_r{i}")
                 for i, f in enumerate(features)])
    return k.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_r{i}").alias("r"))
                                       for i, f in enumerate(features)])))


def redundant_features(df: DataFrame, features: Sequence[str], target: str = "Class",
                       threshold: float = 0.95, method: str = "pearson") -> DataFrame:
    """Greedy pruning. The pair table (features^2 rows, computed on Spark)
    is walked on the driver by |r| descending while >= threshold; pairs with
    a dropped member are skipped; the member less correlated with the target
    is dropped (a tie drops the second). Ties in |r| are broken by pair order."""
    spark = df.sparkSession
    src = df
    if method == "spearman":
        for c in [*features, target]:
            src = average_ranks(src, c)
    elif method != "pearson":
        raise ValueError("method must be 'pearson' or 'spearman'")
    pairs = corr_pairs(src, features).collect()
    tc = {r["feature"]: (abs(r["r"]) if r["r"] is not None else 0.0)
          for r in target_corr(src, features, target).collect()}
    order = {f: i for i, f in enumerate(features)}
    cand = sorted([p for p in pairs if p["r"] is not None and abs(p["r"]) >= threshold],
                  key=lambda p: (-abs(p["r"]), order[p["a"]], order[p["b"]]))
    dropped: dict[str, tuple] = {}
    for p in cand:
        a, b = p["a"], p["b"]
        if a in dropped or b in dropped:
            continue
        loser = a if tc.get(a, 0.0) < tc.get(b, 0.0) else b
        keeper = b if loser == a else a
        dropped[loser] = (keeper, abs(p["r"]))
    rows = [(f, "dropped" if f in dropped else "kept", dropped.get(f, (None, None))[0],
             dropped.get(f, (None, None))[1], tc.get(f, 0.0)) for f in features]
    return spark.createDataFrame(rows, "feature string, status string, because_of string, abs_r double, "
                                       "abs_target_r double")


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by its average rank over ties (1-based), from the
    distributed running sums over distinct values."""
    from vigil.operators.primitives import running_sums
    d = df.groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
    r = running_sums(d, column, ["_c"]).select(
        column, (F.col("_c_cum") - (F.col("_c") - 1) / 2.0).alias("_avg_rank"))
    return df.join(r, column, "left").drop(column).withColumnRenamed("_avg_rank", column)


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max], the last bin closed:
    bin, lo, hi, n, density = n / (N * width)."""
    x = F.col(column).cast("double")
    mm = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.count(x).alias("_N"))
    lo_s, hi_s = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
    idx = F.when(hi_s == lo_s, F.lit(0)).otherwise(
        F.least(F.floor((x - lo_s) / (hi_s - lo_s) * bins), F.lit(bins - 1)))
    b = df.where(x.isNotNull()).withColumn("bin", idx.cast("long"))
    c = b.groupBy("bin").agg(F.count(F.lit(1)).cast("long").alias("n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    allb = mm.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (allb.withColumn("bin", F.col("bin").cast("long")).join(c, "bin", "left").fillna(0, ["n"])
            .select("bin", (F.col("_lo") + F.col("bin") * width).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("hi"), "n",
                    F.try_divide(F.col("n"), F.col("_N") * width).alias("density")))


def box_stats(df: DataFrame, features: Sequence[str], label: str = "Class") -> DataFrame:
    """per (feature, label): quartiles, 1.5 IQR whiskers (extreme values
    inside the fences) and the number of values outside them."""
    long = to_long(df, [label], features)
    q = exact_quantiles(long, [0.25, 0.5, 0.75], group=["feature", label])
    qw = q.groupBy("feature", label).pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("q"))
    qw = qw.select("feature", label, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"),
                   F.col("`0.75`").alias("q3"))
    qw = qw.withColumn("_lf", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
        .withColumn("_hf", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    # qw: one row per (feature, label)
    j = long.join(F.broadcast(qw), ["feature", label])
    inside = (F.col("value") >= F.col("_lf")) & (F.col("value") <= F.col("_hf"))
    return j.groupBy("feature", label, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.count_if(~inside).cast("long").alias("n_outliers"))


def error_by_bin(binned: DataFrame, label: str = "y_true", pred: str = "y_pred", bin_col: str = "bin") -> DataFrame:
    """per bin: n, fraud_rate, precision, recall (denominators at least 1), fp, fn."""
    y, p = F.col(label), F.col(pred)
    tp = F.count_if((p == 1) & (y == 1))
    return binned.groupBy(bin_col).agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.avg(y).alias("fraud_rate"),
        (tp / F.greatest(F.count_if(p == 1), F.lit(1))).alias("precision"),
        (tp / F.greatest(F.count_if(y == 1), F.lit(1))).alias("recall"),
        F.count_if((p == 1) & (y == 0)).cast("long").alias("fp"),
        F.count_if((p == 0) & (y == 1)).cast("long").alias("fn"))


def score_summary(df: DataFrame, score: str = "score", label: str = "Class") -> DataFrame:
    """score range, mean score and base rate."""
    return df.agg(F.min(score).alias("score_min"), F.max(score).alias("score_max"),
                  F.avg(score).alias("score_mean"), F.avg(label).alias("base_rate"))


@dataclass
class Projection:
    """A linear projection: its strengths, the loadings (features x components) and the shift that is taken off first."""
    features: list[str]
    #: explained variance ratios (PCA) or singular values (SVD)
    values: list[float]
    loadings: np.ndarray
    shift: np.ndarray

    def rows(self, df: DataFrame, prefix: str = "pc") -> DataFrame:
        """``df`` with one column for each component; NULL where a feature is missing. Plain column arithmetic."""
        x = [F.col(f).cast("double") - F.lit(float(m)) for f, m in zip(self.features, self.shift)]
        whole = F.lit(True)
        for f in self.features:
            whole = whole & finite(F.col(f).cast("double"))
        return df.withColumns({f"{prefix}{k + 1}": F.when(whole, sum([a * F.lit(float(w)) for a, w in zip(x, self.loadings[:, k])], F.lit(0.0)))
                               for k in range(self.loadings.shape[1])})


def _moments(df: DataFrame, features: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, population covariances) of the rows without missing features: one aggregate, features squared numbers."""
    x = df.select(*[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    for c in x.columns:
        x = x.where(finite(c))
    d = len(features)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    r = x.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{c}") for c in x.columns],
              *[F.covar_pop(f"_x{i}", f"_x{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    if not r["n"]:
        raise ValueError("There is no row in which all features have values.")
    cov = np.zeros((d, d))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
    return r["n"], np.array([r[f"m{c}"] for c in x.columns]), cov


def _axes(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading eigenvalues and vectors; of each vector the entry largest in size (the first of equal ones) is positive."""
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:k]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * np.where(sign == 0, 1.0, sign)


def pca(df: DataFrame, features: Sequence[str], k: int = 3) -> Projection:
    """the first k principal components, from the covariance matrix (one aggregate)."""
    _, means, cov = _moments(df, features)
    values, vectors = _axes(cov, k)
    total = float(np.trace(cov))
    return Projection(list(features), [float(v) / total if total else 0.0 for v in values], vectors, means)


def truncated_svd(df: DataFrame, features: Sequence[str], k: int = 3) -> Projection:
    """the k leading singular directions of the uncentred matrix, from its Gram matrix n * (cov + mean mean')."""
    n, means, cov = _moments(df, features)
    values, vectors = _axes(n * (cov + np.outer(means, means)), k)
    return Projection(list(features), [float(v) ** 0.5 for v in values], vectors, np.zeros(len(means)))


def pca_variance(df: DataFrame, features: Sequence[str], k: int = 3) -> DataFrame:
    """(component, explained_variance_ratio)."""
    values = pca(df, features, k).values
    return df.sparkSession.createDataFrame([(i + 1, v) for i, v in enumerate(values)], "component int, explained_variance_ratio double")


def svd_values(df: DataFrame, features: Sequence[str], k: int = 3) -> DataFrame:
    """(component, singular_value)."""
    values = truncated_svd(df, features, k).values
    return df.sparkSession.createDataFrame([(i + 1, v) for i, v in enumerate(values)], "component int, singular_value double")


def kernel_density(df: DataFrame, column: str, points: int = 50, bandwidth: float | None = None) -> DataFrame:
    """F17 (kernel part): Gaussian kernel density of ``column`` on an even grid
    of ``points`` over [min, max]; bandwidth by Scott's rule
    (std * n^(-1/5)) unless given. Each row adds one kernel value per grid
    point (a fixed-size array) and the sums are partially aggregated per
    partition, so the work is linear in the rows with no join of data and grid.
    Returns (point, x, density)."""
    x = F.col(column).cast("double")
    clean = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    st = clean.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.stddev_samp("_x").alias("sd"),
                   F.count(F.lit(1)).alias("n")).first()  # one row of moments
    if st["n"] == 0:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = bandwidth or (st["sd"] * st["n"] ** (-1 / 5) if st["sd"] else 1.0)
    step = (st["hi"] - st["lo"]) / (points - 1) if points > 1 else 0.0
    grid = [st["lo"] + i * step for i in range(points)]
    g = F.array(*[F.lit(float(v)) for v in grid])
    k = F.transform(g, lambda v: F.exp(-0.5 * F.pow((v - F.col("_x")) / F.lit(h), 2)))
    sums = clean.select(F.posexplode(k).alias("point", "kv")).groupBy("point").agg(F.sum("kv").alias("s"))
    norm = 1.0 / (st["n"] * h * (2 * 3.141592653589793) ** 0.5)
    xs = F.element_at(g, F.col("point") + 1)
    return sums.select(F.col("point").cast("int").alias("point"), xs.alias("x"), (F.col("s") * norm).alias("density"))


def head_tail(df: DataFrame, order: str, n: int, key: str) -> DataFrame:
    """H6: the n first and n last rows by ``order`` (ties by ``key``), each a
    bounded TakeOrdered; rows tagged with ``end`` ('head'/'tail') and position."""
    from pyspark.sql import Window
    head = df.orderBy(F.col(order).desc(), F.col(key)).limit(n).withColumn("end", F.lit("head"))
    tail = df.orderBy(F.col(order).asc(), F.col(key)).limit(n).withColumn("end", F.lit("tail"))
    both = head.unionByName(tail)
    # at most 2n rows, one window per end
    w = Window.partitionBy("end").orderBy(F.when(F.col("end") == "head", -F.col(order)).otherwise(F.col(order)), key)
    return both.withColumn("position", F.row_number().over(w))
