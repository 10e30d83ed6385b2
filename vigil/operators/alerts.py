"""Alert budgets, batch merges and best-run choice (H1-H6).

The whole-table budget ranks every row with the distributed ``global_rank``
(hot tied scores are split by key prefix). Per-batch budgets use a window
partitioned by batch, whose partitions are bounded by the batch size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.scalars import metric_direction, normalize_metric, split_names
from vigil.operators.primitives import global_rank

# Fixed value (must equal the reference's): the default alert cap per request.
DEFAULT_ALERT_CAP = 100


def resolve_cap(outer: Column, inner: Column | None = None, default: int = DEFAULT_ALERT_CAP) -> Column:
    """H3: request value, else the inner value, else the default; an outer 0
    falls through to an inner one (as the nested request shape does) and is
    kept when there is none: a cap of 0 means no alerts."""
    if inner is None:
        return F.coalesce(outer, F.lit(default))
    return F.coalesce(F.nullif(outer, F.lit(0)), inner, outer, F.lit(default))


def alert_budget(df: DataFrame, score: str, key_hex: str, max_alerts: int = DEFAULT_ALERT_CAP) -> DataFrame:
    """H1 over a whole table: rank (score desc, key asc), alert = rank <= k with
    k = min(max(cap, 0), n); threshold = lowest alerted score, 1.0 if k = 0.
    Missing scores (NULL, NaN) rank last."""
    cap = max(int(max_alerts), 0)
    df = df.withColumn("_rank_score", F.when(~F.isnan(score), F.col(score)))
    ranked = global_rank(df, key_hex, order="_rank_score", descending=True, rank_col="rank").drop("_rank_score")
    k = F.least(F.lit(cap), df.agg(F.count(F.lit(1))).scalar()).cast("long")
    alerted = ranked.withColumn("k", k).withColumn("alert", (F.col("rank") <= F.col("k")).cast("int"))
    # lowest alerted score = the k-th score, whichever of equal ones it is: a bounded
    # TakeOrdered (at most k rows) that does not read the key
    th = df.select("_rank_score").orderBy(F.col("_rank_score").desc()).limit(cap).agg(F.min("_rank_score")).scalar()
    return alerted.withColumn("threshold", F.when(F.col("k") > 0, th).otherwise(F.lit(1.0)))


def alert_budget_per_batch(df: DataFrame, score: str, key: str, batch_col: str = "batch_id",
                           max_alerts: int | None = None, alert_rate: float | None = None) -> DataFrame:
    """H2 + H1 per batch: cap = explicit value, else ceil(rate * batch rows)."""
    if max_alerts is None and alert_rate is None:
        max_alerts = DEFAULT_ALERT_CAP
    if max_alerts is None and not 0.0 <= alert_rate <= 1.0:
        raise ValueError("alert_rate must be between 0.0 and 1.0.")
    wb = Window.partitionBy(batch_col)
    w = wb.orderBy(F.when(~F.isnan(score), F.col(score)).desc(), F.col(key).asc())  # missing scores last
    out = df.withColumn("batch_rows", F.count(F.lit(1)).over(wb))
    cap = F.lit(max(int(max_alerts), 0)) if max_alerts is not None else \
        F.ceil(F.lit(float(alert_rate)) * F.col("batch_rows"))
    out = (out.withColumn("max_alerts", cap.cast("long"))
           .withColumn("k", F.least("max_alerts", "batch_rows").cast("long"))
           .withColumn("rank", F.row_number().over(w).cast("long"))
           .withColumn("alert", (F.col("rank") <= F.col("k")).cast("int")))
    th = F.min(F.when(F.col("alert") == 1, F.col(score))).over(wb)
    return out.withColumn("threshold", F.when(F.col("k") > 0, th).otherwise(F.lit(1.0)))


def batch_summaries(per_row: DataFrame, batch_col: str = "batch_id", score: str | None = "score") -> DataFrame:
    """One response summary per batch: predictions, alerts, threshold, cap."""
    has_p = F.count(F.col(score)) == F.count(F.lit(1)) if score else F.lit(False)
    return per_row.groupBy(batch_col).agg(
        F.count(F.lit(1)).cast("long").alias("n_predictions"), F.sum("alert").cast("long").alias("num_alerts"),
        F.first("threshold").alias("threshold_used"), F.first("max_alerts").alias("max_alerts"),
        has_p.alias("has_probabilities"))


def merge_batches(summaries: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """H4: predictions appended; probabilities only if every batch has them;
    threshold, cap and alert count taken from the first batch that has them."""
    def first_non_null(c: str) -> Column:
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(batch_col)))
    return summaries.agg(
        F.sum("n_predictions").cast("long").alias("n_predictions"),
        F.sum("num_alerts").cast("long").alias("total_alerts"),
        F.bool_and("has_probabilities").alias("probabilities_available"),
        first_non_null("threshold_used").alias("threshold_used"),
        first_non_null("max_alerts").alias("max_alerts"),
        first_non_null("num_alerts").alias("num_alerts"),
        F.count(F.lit(1)).cast("long").alias("n_batches"))


def best_runs(runs: DataFrame, run_metrics: DataFrame, metrics: Sequence[str],
              experiments: str | Sequence[str] = "custom_train, automl_train",
              status: str | None = "FINISHED", direction: str | None = None) -> DataFrame:
    """H5 for several requested metrics at once: for each, normalise the name
    (B14), pick its direction (B15), keep runs of the chosen experiments
    (B16) and status with a non-null value, and take the best (ties: run_id)."""
    spark = runs.sparkSession
    exp_text = experiments if isinstance(experiments, str) else ",".join(experiments)
    if not exp_text.replace(",", " ").strip():
        raise ValueError("Name at least one experiment.")
    req = spark.createDataFrame([(m,) for m in metrics], "requested string")
    req = req.select("requested", normalize_metric("requested").alias("m"))
    bad = [r["requested"] for r in req.where(~F.col("m.valid")).select("requested").collect()]
    if bad:
        raise ValueError(f"Metric '{bad[0]}' is not a recognized metric.")
    req = req.select("requested", F.col("m.bare").alias("metric"),
                     (F.lit(direction) if direction else metric_direction("m.bare")).alias("direction"))
    exps = runs.sparkSession.range(1).select(F.explode(split_names(F.lit(exp_text))).alias("experiment_name"))
    r = runs.join(F.broadcast(exps), "experiment_name", "left_semi")
    if status:
        r = r.where(F.col("status") == status)
    vals = (run_metrics.join(r.select("run_id", "experiment_name"), "run_id")
            .join(F.broadcast(req), run_metrics["key"] == req["metric"]).where(F.col("value").isNotNull()))
    order = F.struct(F.when(F.col("direction") == "min", F.col("value")).otherwise(-F.col("value")), F.col("run_id"))
    return vals.groupBy("requested", "metric", "direction").agg(
        F.min_by(F.struct("run_id", "experiment_name", "value"), order).alias("b")).select(
        "requested", "metric", "direction", "b.run_id", "b.experiment_name", F.col("b.value").alias("metric_value"))
