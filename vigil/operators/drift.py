"""Drift between a reference and a current table.

All features are handled in one job: both tables are unpivoted to
(feature, value) rows, tagged with a side flag and processed with grouped
aggregates. PSI edges are exact numpy-style quantiles of the reference side;
KS uses cumulative counts over the distinct values of both sides.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.schema import numeric_features, shared_numeric
from vigil.operators.primitives import materialize, running_sums, to_long
from vigil.operators.select import edge_bin, exact_quantiles

EPS = 1e-6


@dataclass(frozen=True)
class DriftConfig:
    label_column: str = "Class"
    psi_bins: int = 10
    psi_threshold: float = 0.2
    ks_threshold: float = 0.1
    include_ks: bool = True


def sided_long(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, side) with side 0 = reference, 1 = current; finite values only."""
    r = to_long(reference.select(*features), [], features).withColumn("side", F.lit(0))
    c = to_long(current.select(*features), [], features).withColumn("side", F.lit(1))
    return r.unionByName(c)


def _interior_probs(bins: int) -> list[float]:
    if bins < 2:
        raise ValueError("psi_bins must be >= 2")
    return [i / bins for i in range(1, bins)]


def psi_edges(long_ref: DataFrame, bins: int = 10) -> DataFrame:
    """(feature, edges) — the distinct interior quantile edges of the
    reference side, sorted; the outer edges are -inf / +inf implicitly."""
    q = exact_quantiles(long_ref, _interior_probs(bins), group="feature", value="value")
    return q.groupBy("feature").agg(F.array_sort(F.array_distinct(F.collect_list("q"))).alias("edges"))


def distinct_counts(long: DataFrame) -> DataFrame:
    """(feature, value, _nr, _nc): the sided long table reduced to distinct
    values (map-side partial aggregation); every later step reads this."""
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("_nr"), F.count_if(F.col("side") == 1).alias("_nc"))


def drift_tables(long: DataFrame, bins: int = 10, with_ks: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """PSI (feature, psi, n_ref, n_cur) and KS (feature, ks).

    PSI takes its edges by selection on the reference side and counts bins in
    one grouped pass; only KS needs the order of the distinct values."""
    d = materialize(distinct_counts(long)) if with_ks else None
    edges = psi_edges(long.where(F.col("side") == 0), bins)
    # edges has one short row per feature: bounded by the feature count.
    counts = (long.join(F.broadcast(edges), "feature", "left")
              .withColumn("bin", edge_bin(F.col("value"), F.col("edges"), bins - 1))
              .groupBy("feature", "bin").agg(F.count_if(F.col("side") == 0).alias("_nr"), F.count_if(F.col("side") == 1).alias("_nc")))
    w = Window.partitionBy("feature")  # at most `bins` rows per feature
    every = edges.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin"))
    full = (counts.join(every, ["feature", "bin"], "full").fillna(0, ["_nr", "_nc"])
            .withColumn("_tr", F.sum("_nr").over(w)).withColumn("_tc", F.sum("_nc").over(w)))
    full = (full.withColumn("_rs", F.greatest(F.try_divide("_nr", "_tr"), F.lit(EPS)))
            .withColumn("_cs", F.greatest(F.try_divide("_nc", "_tc"), F.lit(EPS))))
    full = (full.withColumn("_rs", F.col("_rs") / F.sum("_rs").over(w))
            .withColumn("_cs", F.col("_cs") / F.sum("_cs").over(w)))
    psi = full.groupBy("feature").agg(
        F.when((F.max("_tr") > 0) & (F.max("_tc") > 0),
               F.sum((F.col("_rs") - F.col("_cs")) * F.log(F.col("_rs") / F.col("_cs")))).alias("psi"),
        F.max("_tr").cast("long").alias("n_ref"), F.max("_tc").cast("long").alias("n_cur"))
    return psi, _ks(d) if with_ks else None


def _ks(d: DataFrame) -> DataFrame:
    """(feature, ks) from ``distinct_counts``."""
    tot = d.groupBy("feature").agg(F.sum("_nr").alias("_tr"), F.sum("_nc").alias("_tc"))
    cum = running_sums(d, "value", ["_nr", "_nc"], group="feature")
    # tot has one row per feature.
    gaps = cum.join(F.broadcast(tot), "feature").select(
        "feature", F.abs(F.try_divide("_nr_cum", "_tr") - F.try_divide("_nc_cum", "_tc")).alias("_gap"),
        "_tr", "_tc")
    return gaps.groupBy("feature").agg(
        F.when((F.max("_tr") > 0) & (F.max("_tc") > 0), F.max("_gap")).alias("ks"))


def psi_by_feature(long: DataFrame, bins: int = 10) -> DataFrame:
    """F10 + F11: (feature, psi, n_ref, n_cur) from a sided long table;
    ``psi`` is NULL when a side has no finite value."""
    return drift_tables(long, bins, with_ks=False)[0]


def ks_by_feature(long: DataFrame) -> DataFrame:
    """(feature, ks) — max gap of the right-continuous empirical CDFs,
    evaluated at every observed value; NULL when a side is empty."""
    return _ks(materialize(distinct_counts(long)))


def drift_report(reference: DataFrame, current: DataFrame, config: DriftConfig = DriftConfig(),
                 features: Iterable[str] | None = None) -> DataFrame:
    """feature, psi, ks, psi_exceeds, ks_exceeds (one row per feature)."""
    if features is None:
        feats = numeric_features(current, config.label_column, reference=reference)
    else:
        feats = [c for c in features if c in reference.columns and c in current.columns]
        if not feats:
            raise ValueError("No numeric features found for drift computation.")
    long = sided_long(reference, current, feats)
    names = long.sparkSession.createDataFrame([(f,) for f in feats], "feature string")
    psi, ks = drift_tables(long, config.psi_bins, with_ks=config.include_ks)
    rep = names.join(psi.select("feature", "psi"), "feature", "left")
    if config.include_ks:
        rep = rep.join(ks, "feature", "left")
    else:
        rep = rep.withColumn("ks", F.lit(None).cast("double"))
    return rep.select(
        "feature", "psi", "ks",
        F.coalesce(F.col("psi") >= F.lit(config.psi_threshold), F.lit(False)).alias("psi_exceeds"),
        (F.coalesce(F.col("ks") >= F.lit(config.ks_threshold), F.lit(False)) & F.lit(config.include_ks))
        .alias("ks_exceeds"))


def drift_summary(report: DataFrame, config: DriftConfig = DriftConfig()) -> DataFrame:
    """one-row summary; NULLs are skipped by max/avg, as in the reference."""
    ks_on = F.lit(config.include_ks)
    return report.agg(
        F.count(F.lit(1)).cast("long").alias("feature_count"),
        F.lit(float(config.psi_threshold)).alias("psi_threshold"),
        F.lit(float(config.ks_threshold)).alias("ks_threshold"),
        F.max("psi").alias("psi_max"), F.avg("psi").alias("psi_mean"),
        F.when(ks_on, F.max("ks")).alias("ks_max"), F.when(ks_on, F.avg("ks")).alias("ks_mean"),
        F.count_if("psi_exceeds").cast("long").alias("psi_exceeded_count"),
        F.when(ks_on, F.count_if("ks_exceeds")).otherwise(0).cast("long").alias("ks_exceeded_count"),
    ).withColumn("drift_detected", (F.col("psi_exceeded_count") > 0) | (ks_on & (F.col("ks_exceeded_count") > 0)))


def drift_metric_map(reference: DataFrame, current: DataFrame, method: str = "psi", bins: int = 10) -> DataFrame:
    """rows (metric, value) keyed ``drift.{method}.{column}`` over the
    shared numeric columns (label included)."""
    method = method.lower()
    if method not in {"psi", "ks"}:
        raise ValueError(f"Unsupported drift method: {method!r}")
    cols = shared_numeric(reference, current)
    long = sided_long(reference, current, cols)
    names = long.sparkSession.createDataFrame([(f,) for f in cols], "feature string")
    vals = psi_by_feature(long, bins).select("feature", F.col("psi").alias("v")) if method == "psi" \
        else ks_by_feature(long).select("feature", F.col("ks").alias("v"))
    return names.join(vals, "feature", "left").select(
        F.concat(F.lit(f"drift.{method}."), "feature").alias("metric"), F.col("v").alias("value"))


def drift_log_metrics(summary: DataFrame) -> DataFrame:
    """F16 tail: the seven logged numbers as (key, value) rows, NULLs dropped."""
    s = summary
    pairs = [("drift.psi_max", "psi_max"), ("drift.psi_mean", "psi_mean"),
             ("drift.psi_exceeded_count", "psi_exceeded_count"), ("drift.ks_max", "ks_max"),
             ("drift.ks_mean", "ks_mean"), ("drift.ks_exceeded_count", "ks_exceeded_count")]
    arr = F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).cast("double").alias("value")) for k, c in pairs],
                  F.struct(F.lit("drift.detected").alias("key"),
                           F.col("drift_detected").cast("double").alias("value")))
    return s.select(F.inline(arr)).where(F.col("value").isNotNull())


def run_drift_check(reference: DataFrame, current: DataFrame, output_dir: str, run_id: str,
                    config: DriftConfig = DriftConfig(), features: Iterable[str] | None = None) -> DataFrame:
    """F16: choose features (B5), build the report (F13) and summary (F14),
    write both (A8, NaN as NULL) and append the seven run metrics to
    ``output_dir/metrics`` (A9, NULLs dropped). Returns the logged metrics,
    read back from the written table."""
    from vigil.sources.files import log_metrics, write_report
    # one row per feature, written three times: compute it once
    report = materialize(drift_report(reference, current, config, features))
    summary = materialize(drift_summary(report, config))
    write_report(report, output_dir + "/drift_report", "json")
    write_report(report, output_dir + "/drift_report_csv", "csv")
    write_report(summary, output_dir + "/drift_summary", "json")
    log_metrics(drift_log_metrics(summary), run_id, output_dir + "/metrics")
    return report.sparkSession.read.parquet(output_dir + "/metrics")
