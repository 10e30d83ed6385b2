"""Classifier metrics from (label, score[, prediction]) columns.

Rank metrics are tie-exact: rows are first grouped by distinct score (ties
collapse), then cumulative positive/negative counts in descending score
order come from the distributed ``running_sums``. One such curve table
serves average precision, ROC-AUC, the precision-recall curve and the
threshold pickers. An optional ``group`` computes everything per group in
the same job (per feature, per fold, per model).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.primitives import _cols, _null_safe, finite, materialize, running_sums
from vigil.operators.select import edge_bin, exact_quantiles

LOG_EPS = 1e-15


def _prep(df: DataFrame, label: str, score: str, group: list[str]) -> DataFrame:
    p = F.col(score).cast("double")
    return df.select(*group, F.col(label).cast("int").alias("_y"), F.when(finite(p), p).alias("_p"))


def curve(df: DataFrame, label: str = "Class", score: str = "score",
          group: str | Sequence[str] | None = None, drop_missing: bool = False, count: str | None = None) -> DataFrame:
    """One row per (group, distinct score): pos, neg, tp, fp (cumulative over
    scores >= this one), P, N (group totals).

    A group in which any score is missing (NULL, NaN, infinite) has NULL totals
    and so no AP or AUC, unless ``drop_missing`` leaves such rows out (for
    features, whose missing values are no failure of a model). ``count`` names
    how many rows each row stands for."""
    return curve_of_counts(score_counts(df, label, score, group, count), group, drop_missing)


def score_counts(df: DataFrame, label: str = "Class", score: str = "score", group: str | Sequence[str] | None = None,
                 count: str | None = None) -> DataFrame:
    """One row per (group, distinct score ``_p``; NULL if missing): pos, neg. The only pass over the rows."""
    g = _cols(group)
    if count:
        hit, n = F.col("_y") == 1, F.col(count)
        rows = df.select(*g, n, F.col(label).cast("int").alias("_y"), F.when(finite(F.col(score).cast("double")), F.col(score).cast("double")).alias("_p"))
        return materialize(rows.groupBy(*g, "_p").agg(F.coalesce(F.sum(F.when(hit, n)), F.lit(0)).cast("long").alias("pos"),
                                                     F.coalesce(F.sum(F.when(~hit, n)), F.lit(0)).cast("long").alias("neg")))
    return materialize(_prep(df, label, score, g).groupBy(*g, "_p").agg(
        F.count_if(F.col("_y") == 1).cast("long").alias("pos"),
        F.count_if(F.col("_y") != 1).cast("long").alias("neg")))


def curve_of_counts(every: DataFrame, group: str | Sequence[str] | None = None, drop_missing: bool = False) -> DataFrame:
    """``curve`` of a table as ``score_counts`` gives it."""
    g = _cols(group)
    d = every.where(F.col("_p").isNotNull())
    whole = F.lit(True) if drop_missing else F.count("_p") == F.count(F.lit(1))
    pos, neg = F.when(whole, F.sum("pos")).alias("P"), F.when(whole, F.sum("neg")).alias("N")
    cum = running_sums(d, "_p", ["pos", "neg"], group=g or None, descending=True)
    if g:
        tot = every.groupBy(*g).agg(pos, neg)
        # tot has one row per group.
        j = _null_safe(cum, tot, g, "inner")
    else:
        # whole-table totals as scalar subqueries
        j = cum.withColumn("P", every.agg(pos).scalar()).withColumn("N", every.agg(neg).scalar())
    return j.select(*g, F.col("_p").alias("threshold"), "pos", "neg",
                    F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"), "P", "N")


def average_precision(c: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Step-wise AP, Σ pos_g · precision_g / P; NULL when P = 0."""
    g = list(group)
    return c.groupBy(*g).agg(F.when(F.max("P") > 0, F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
                                    / F.max("P")).alias("average_precision"))


def average_precision_reversed(c: DataFrame, group: Sequence[str] = (), flip_labels: bool = False) -> DataFrame:
    """AP of the negated score from the curve of the score itself: the counts
    from the other end are the totals less the counts before. With
    ``flip_labels`` also of the other class, as for (1 - y, 1 - p)."""
    g = list(group)
    tp, fp = F.col("P") - F.col("tp") + F.col("pos"), F.col("N") - F.col("fp") + F.col("neg")
    at, total, hit = (F.col("neg"), F.max("N"), fp) if flip_labels else (F.col("pos"), F.max("P"), tp)
    return c.groupBy(*g).agg(F.when(total > 0, F.sum(at * (hit / (tp + fp))) / total).alias("average_precision"))


def roc_auc(c: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Σ pos_g · (negatives below + ties / 2) / (P · N); NULL if P or N is 0."""
    g = list(group)
    below = F.col("N") - F.col("fp")
    return c.groupBy(*g).agg(F.when((F.max("P") > 0) & (F.max("N") > 0), F.sum(
        F.col("pos") * (below + F.col("neg") / 2.0)) / (F.max("P") * F.max("N"))).alias("roc_auc"))


def pr_curve(c: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) at every distinct score plus the
    final point (NULL threshold, precision 1, recall 0). Where a score is
    missing (NULL totals), precision and recall are NULL."""
    g = list(group)
    known = F.col("P").isNotNull()
    pts = c.select(*g, "threshold", F.when(known, F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                   F.when(F.col("P") > 0, F.col("tp") / F.col("P")).when(known, F.lit(1.0)).alias("recall"))
    last = c.select(*g).distinct().select(*g, F.lit(None).cast("double").alias("threshold"),
                                           F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(last)


def best_f1_threshold(c: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Threshold maximising 2pr/(p+r+1e-12); ties go to the lowest threshold; NULL where a score is missing."""
    g = list(group)
    pts = pr_curve(c, g).where(F.col("threshold").isNotNull())
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-12)
    pts = pts.withColumn("f1", f1)
    best = pts.groupBy(*g).agg(F.min_by(F.struct("threshold", "precision", "recall", "f1"),
                                        F.when(F.col("f1").isNotNull(), F.struct(-F.col("f1"), F.col("threshold")))).alias("b"))
    return best.select(*g, "b.threshold", "b.precision", "b.recall", "b.f1")


def recall_at_precision(c: DataFrame, min_precision: float = 0.10, group: Sequence[str] = ()) -> DataFrame:
    """Highest recall with precision >= floor (lowest threshold on ties);
    if no threshold reaches the floor, the highest precision; NULL where a score is missing."""
    g = list(group)
    pts = pr_curve(c, g).where(F.col("threshold").isNotNull())
    ok = F.col("precision") >= min_precision
    res = pts.groupBy(*g).agg(
        F.min_by(F.struct("threshold", "precision", "recall"),
                 F.when(ok, F.struct(-F.col("recall"), F.col("threshold")))).alias("a"),
        F.min_by(F.struct("threshold", "precision", "recall"),
                 F.when(F.col("precision").isNotNull(), F.struct(-F.col("precision"), F.col("threshold")))).alias("b"),
        F.when(F.count("precision") > 0, F.count_if(ok)).alias("_nok"))
    pick = F.when(F.col("_nok") > 0, F.col("a")).otherwise(F.col("b"))
    return res.select(*g, pick["threshold"].alias("threshold"), pick["precision"].alias("precision"),
                      pick["recall"].alias("recall"), (F.col("_nok") > 0).alias("meets_floor"))


def confusion_counts(df: DataFrame, label: str, pred: str, group: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """G1 core: one row (tn, fp, fn, tp, n) per group. ``count`` names how many rows each row stands for."""
    g = list(group)
    y, p = F.col(label), F.col(pred)
    if count:
        n = F.col(count)

        def counted(of: Column) -> Column:
            return F.coalesce(F.sum(F.when(of, n)), F.lit(0)).cast("long")
        return df.groupBy(*g).agg(counted((y == 0) & (p == 0)).alias("tn"), counted((y == 0) & (p == 1)).alias("fp"),
                                  counted((y == 1) & (p == 0)).alias("fn"), counted((y == 1) & (p == 1)).alias("tp"),
                                  counted(F.lit(True)).alias("n"), F.sum(p.cast("long") * n).alias("pred_sum"))
    return df.groupBy(*g).agg(F.count_if((y == 0) & (p == 0)).cast("long").alias("tn"),
                              F.count_if((y == 0) & (p == 1)).cast("long").alias("fp"),
                              F.count_if((y == 1) & (p == 0)).cast("long").alias("fn"),
                              F.count_if((y == 1) & (p == 1)).cast("long").alias("tp"),
                              F.count(F.lit(1)).cast("long").alias("n"),
                              F.sum(p.cast("long")).alias("pred_sum"))


def confusion_long(k: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """G1: (actual, predicted, n) with zero cells kept, labels fixed to [0, 1]."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return k.select(*group, F.inline(F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"),
                                                        F.col(c).alias("n")) for a, b, c in cells])))


def _div0(a: Column, b: Column) -> Column:
    """Zero-division gives 0, as in the scoring library defaults."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def basic_metrics(k: DataFrame) -> DataFrame:
    """G2 + G3: accuracy, precision, recall, f1, alert_rate, alert_count."""
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    prec, rec = _div0(tp, tp + fp), _div0(tp, tp + fn)
    return k.select(
        _div0(tp + tn, n).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.when(n > 0, F.col("pred_sum") / n).alias("alert_rate"),
        F.when(n > 0, F.col("pred_sum").cast("double")).alias("alert_count"))


def classification_report(k: DataFrame) -> DataFrame:
    """Rows for '0', '1', 'macro avg', 'weighted avg' (precision, recall,
    f1-score, support) and 'accuracy'."""
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1_1, f1_0 = _div0(2 * tp, 2 * tp + fp + fn), _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    acc = _div0(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.alias("support"))
    w = lambda a, b: _div0(a * s0 + b * s1, n)
    return k.select(F.inline(F.array(
        row("0", p0, r0, f1_0, s0), row("1", p1, r1, f1_1, s1),
        row("accuracy", acc, acc, acc, n.cast("double")),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n.cast("double")),
        row("weighted avg", w(p0, p1), w(r0, r1), w(f1_0, f1_1), n.cast("double")))))


def report_at_threshold(scored: DataFrame, threshold: Column, label: str = "Class", score: str = "score") -> DataFrame:
    """The classification report of ``score >= threshold`` with the threshold itself; all
    NULL (but the supports) if there is no threshold or a score is missing."""
    p = F.col(score).cast("double")
    marked = scored.select(F.col(label), F.when(finite(p) & threshold.isNotNull(), (p >= threshold).cast("int")).alias("_pred"))
    whole = marked.agg(F.count("_pred") == F.count(F.lit(1))).scalar()
    rep = classification_report(confusion_counts(marked.withColumn("_pred", F.coalesce("_pred", F.lit(0))), label, "_pred"))
    return rep.select("label", *[F.when(whole, F.col(c)).alias(c) for c in ("precision", "recall", "f1_score")], "support",
                      threshold.alias("threshold"))


def topk_table(df: DataFrame, ks: Sequence[int], label: str = "Class", score: str = "score",
               key: str = "txn_id") -> DataFrame:
    """For each k (capped at n): tp, fp, precision, recall of the k
    highest scores (ties by key). Only the top max(k) rows are ordered
    (TakeOrdered), so the work is bounded by the k list, not the table."""
    spark = df.sparkSession
    kmax = max(int(k) for k in ks)
    top = (df.select(F.col(key).alias("_k"), F.col(score).alias("_p"), F.col(label).alias("_y"))
           .orderBy(F.col("_p").desc(), F.col("_k").asc()).limit(kmax))
    # at most kmax rows: a global window over them is bounded by design
    w = Window.orderBy(F.col("_p").desc(), F.col("_k").asc()).rowsBetween(Window.unboundedPreceding, 0)
    top = top.select(F.row_number().over(Window.orderBy(F.col("_p").desc(), F.col("_k").asc())).alias("rank"),
                     F.sum("_y").over(w).alias("cum_tp"))
    n = df.agg(F.count(F.lit(1))).scalar()
    kdf = spark.createDataFrame([(int(k),) for k in ks], "k_req long")
    kk = kdf.withColumn("P", df.agg(F.sum(label)).scalar()).withColumn("alerts_k", F.least("k_req", n))
    j = kk.join(top, kk["alerts_k"] == top["rank"], "left")
    tp = F.coalesce(F.col("cum_tp"), F.lit(0)).cast("long")
    return j.select("k_req", F.col("alerts_k").cast("long").alias("alerts_k"), tp.alias("tp"),
                    (F.col("alerts_k") - tp).cast("long").alias("fp"),
                    (tp / F.greatest("alerts_k", F.lit(1))).alias("precision"),
                    (tp / F.greatest("P", F.lit(1))).alias("recall"))


def calibration(df: DataFrame, label: str = "Class", score: str = "score", n_bins: int = 10,
                edges: DataFrame | None = None) -> DataFrame:
    """Quantile-strategy calibration: bin = number of interior edges
    strictly below the score; (bin, mean_pred, frac_pos, n) per non-empty bin.
    Rows without a score are in no bin. ``edges``, if given, has one row with
    an array of at most ``n_bins - 1`` edges."""
    d = _prep(df, label, score, []).where(F.col("_p").isNotNull())
    if edges is None:
        probs = [i / n_bins for i in range(1, n_bins)]
        q = exact_quantiles(d.select(F.lit("s").alias("g"), F.col("_p").alias("value")), probs, group="g")
        edges = q.agg(F.array_sort(F.collect_list("q")).alias("edges"))
    e = edges.select("edges").scalar()  # one short array
    b = d.withColumn("_edges", e).withColumn("bin", edge_bin(F.col("_p"), F.col("_edges"), n_bins - 1, closed=False))
    return b.groupBy("bin").agg(F.avg("_p").alias("mean_pred"), F.avg("_y").alias("frac_pos"),
                                F.count(F.lit(1)).cast("long").alias("n"))


def brier(df: DataFrame, label: str = "Class", score: str = "score") -> DataFrame:
    """Mean squared gap between score and label."""
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def feature_ap(df: DataFrame, features: Sequence[str], label: str = "Class") -> DataFrame:
    """AP of each feature and of its negative from one curve each; strength
    is the larger, direction '+' or '-'."""
    long = df.select(F.col(label).alias("_y"), *[F.col(f).cast("double").alias(f) for f in features]) \
        .unpivot(["_y"], list(features), "feature", "value")
    c = curve(long, "_y", "value", group="feature", drop_missing=True)
    ap = average_precision(c, ["feature"]).withColumnRenamed("average_precision", "ap_pos")
    wide = ap.join(average_precision_reversed(c, ["feature"]).withColumnRenamed("average_precision", "ap_neg"), "feature")
    pos, neg = F.col("ap_pos"), F.col("ap_neg")
    return wide.select("feature", "ap_pos", "ap_neg", F.greatest(pos, neg).alias("strength"),
                       F.when(pos >= neg, "+").otherwise("-").alias("direction"))


def log_loss(df: DataFrame, label: str = "Class", score: str = "score") -> DataFrame:
    """Mean negative log-likelihood; NULL if a score is missing."""
    p = F.least(F.greatest(F.col(score), F.lit(LOG_EPS)), F.lit(1 - LOG_EPS))
    y = F.col(label)
    loss = -F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.agg(F.when(F.count(F.when(finite(score), 1)) == F.count(F.lit(1)), loss).alias("log_loss"))


def canonical_metrics(df: DataFrame, label: str = "Class", score: str = "score", pred: str = "pred") -> DataFrame:
    """The 21 canonical run-metric names as (metric, value) rows, from the
    public definitions (binary case; macro/weighted over classes 0 and 1,
    micro over the one-hot pairs (y, p) and (1 - y, 1 - p)). The metrics of
    scores are NULL if one is missing."""
    k = confusion_counts(df, label, pred)
    tp, fp, fn, tn, n = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn", "n"))
    p1, r1, p0, r0 = _div0(tp, tp + fp), _div0(tp, tp + fn), _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1_1, f1_0 = _div0(2 * tp, 2 * tp + fp + fn), _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _div0(tp + tn, n)
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    mcc = F.when(mcc_den > 0, (tp * tn - fp * fn) / mcc_den).otherwise(F.lit(0.0))
    wacc = _div0(s1 * tp + s0 * tn, s1 * s1 + s0 * s0)
    bal = (r0 + r1) / 2
    conf = k.select(
        acc.alias("accuracy"), bal.alias("balanced_accuracy"), wacc.alias("weighted_accuracy"),
        ((bal - 0.5) / 0.5).alias("norm_macro_recall"), mcc.alias("matthews_correlation"),
        acc.alias("precision_score_micro"), ((p0 + p1) / 2).alias("precision_score_macro"),
        _div0(p0 * s0 + p1 * s1, n).alias("precision_score_weighted"),
        acc.alias("recall_score_micro"), bal.alias("recall_score_macro"),
        _div0(r0 * s0 + r1 * s1, n).alias("recall_score_weighted"),
        acc.alias("f1_score_micro"), ((f1_0 + f1_1) / 2).alias("f1_score_macro"),
        _div0(f1_0 * s0 + f1_1 * s1, n).alias("f1_score_weighted"),
        s0.alias("_s0"), s1.alias("_s1"), n.alias("_n"))
    # Class 1 with p, class 0 with 1 - p (the same curve read from its other end), micro = both together.
    every = score_counts(df, label, score)
    c = curve_of_counts(every)
    flipped = every.select((1 - F.col("_p")).alias("_p"), F.col("neg").alias("pos"), F.col("pos").alias("neg"))
    micro = curve_of_counts(materialize(every.unionByName(flipped).groupBy("_p").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))))
    auc = roc_auc(c).scalar()  # the same for both classes
    allm = conf.withColumns({
        "c1_ap": average_precision(c).scalar(), "c0_ap": average_precision_reversed(c, flip_labels=True).scalar(), "micro_ap": average_precision(micro).scalar(),
        "c1_auc": auc, "c0_auc": auc, "micro_auc": roc_auc(micro).scalar()})
    allm = allm.withColumn("log_loss", log_loss(df, label, score).scalar())
    s0c, s1c, nc = F.col("_s0"), F.col("_s1"), F.col("_n")
    allm = allm.select(
        "*",
        ((F.col("c0_auc") + F.col("c1_auc")) / 2).alias("AUC_macro"),
        F.try_divide(F.col("c0_auc") * s0c + F.col("c1_auc") * s1c, nc).alias("AUC_weighted"),
        F.col("micro_auc").alias("AUC_micro"),
        ((F.col("c0_ap") + F.col("c1_ap")) / 2).alias("average_precision_score_macro"),
        F.try_divide(F.col("c0_ap") * s0c + F.col("c1_ap") * s1c, nc).alias("average_precision_score_weighted"),
        F.col("micro_ap").alias("average_precision_score_micro"))
    from vigil.functions.scalars import CANONICAL_METRIC_KEYS
    names = [m[len("metrics."):] for m in CANONICAL_METRIC_KEYS]
    return allm.select(F.inline(F.array(*[
        F.struct(F.lit(f"metrics.{m}").alias("metric"), F.col(m).cast("double").alias("value")) for m in names])))


def platt_training_rows(df: DataFrame, label: str = "Class", score: str = "score") -> DataFrame:
    """G14 helper: Platt's smoothed targets as two weighted rows per record,
    t+ = (P+1)/(P+2) for positives, t- = 1/(N+2) for negatives."""
    j = df.select(F.col(label).alias("_y"), F.col(score).cast("double").alias("s")) \
        .withColumn("_P", df.agg(F.count_if(F.col(label) == 1)).scalar()) \
        .withColumn("_N", df.agg(F.count_if(F.col(label) != 1)).scalar())
    t = F.when(F.col("_y") == 1, (F.col("_P") + 1) / (F.col("_P") + 2)).otherwise(1 / (F.col("_N") + 2))
    one = j.select("s", F.lit(1.0).alias("target"), t.alias("w"))
    zero = j.select("s", F.lit(0.0).alias("target"), (1 - t).alias("w"))
    return one.unionByName(zero)
