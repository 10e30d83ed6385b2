"""User entry points (M1-M4): compositions of the operators.

Everything stays lazy until a writer or the caller acts; the only
driver-side branches are the validation gate (one row) and the promotion
decision (one row per model name).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.scalars import coerce_label, normalize_metric
from vigil.operators import alerts as alert_ops
from vigil.operators import drift as drift_ops
from vigil.operators import metrics as met
from vigil.operators import registry as reg
from vigil.operators import scale as scale_ops
from vigil.operators import split as split_ops
from vigil.operators import validate as val_ops
from vigil.operators.primitives import materialize
from vigil.sources import files as io


@dataclass
class Prepared:
    validation: val_ops.ValidationResult
    train: DataFrame | None
    test: DataFrame | None
    scalers: DataFrame | None
    metadata: DataFrame


def prepare(df: DataFrame, key: str, label: str = "Class", test: float = 0.1, seed: int = 42,
            required_columns: Sequence[str] | None = None, minimum_rows: int = 1000,
            output: str | None = None) -> Prepared:
    """M1: validate -> gate -> split -> fit scalers on train -> scale train ->
    (optionally) write train, test, scalers and metadata. The test part stays
    raw; scaling is applied again when scoring."""
    spark = df.sparkSession
    v = val_ops.validate_data(df, required_columns=required_columns, label_column=label,
                              minimum_rows=minimum_rows, check_balance=True)
    if not v.is_valid():
        reason = "validation failed: " + ", ".join(
            r["check"] for r in v.checks.where(~F.col("passed")).select("check").collect())
        md = val_ops.skip_record(spark, reason)
        if output:
            md.coalesce(1).write.mode("overwrite").json(output + "/metadata")
        return Prepared(v, None, None, None, md)
    marked, sizes = split_ops.mark_split(df, key, label, test=test, seed=seed)
    marked = marked.checkpoint()  # the split is reused by every branch below
    train = marked.where(~F.col("is_test")).drop("is_test")
    test_df = marked.where(F.col("is_test")).drop("is_test")
    params = scale_ops.fit_scalers(train)
    scaled = scale_ops.transform_with_scalers(train, params)
    counts = marked.groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("split")) \
        .agg(F.count(F.lit(1)).alias("n"))
    md = io.split_metadata(spark, counts, df.columns, label, seed, test, ["amount_scaler", "time_scaler"])
    if output:
        io.write_descriptor(scaled, output + "/train")
        io.write_descriptor(test_df, output + "/test")
        params.coalesce(1).write.mode("overwrite").json(output + "/scalers")
        md.coalesce(1).write.mode("overwrite").json(output + "/metadata")
    return Prepared(v, scaled, test_df, params, md)


def evaluate(scored: DataFrame, label: str = "Class", pred: str = "pred", score: str | None = "score") -> DataFrame:
    """M2: (metric, value) rows: accuracy, precision, recall, f1, alert rate
    and count, ROC-AUC and AP (NULL without scores, or if any score is
    missing). Labels are coerced first (B8): an unreadable one counts as 0."""
    scored = scored.withColumn(label, coerce_label(F.col(label), scored.schema[label].dataType))
    # one pass over the rows; both the confusion and the curve are sums of its counts
    counts = materialize(scored.groupBy(label, pred, *([score] if score else [])).agg(F.count(F.lit(1)).alias("_n")))
    b = met.basic_metrics(met.confusion_counts(counts, label, pred, count="_n"))
    if score:
        c = met.curve(counts, label, score, count="_n")
        b = b.withColumn("roc_auc", met.roc_auc(c).scalar()) \
            .withColumn("average_precision", met.average_precision(c).scalar())
    else:
        b = b.withColumn("roc_auc", F.lit(None).cast("double")).withColumn("average_precision",
                                                                           F.lit(None).cast("double"))
    names = [("metrics.accuracy", "accuracy"), ("metrics.precision", "precision"), ("metrics.recall", "recall"),
             ("metrics.f1", "f1"), ("metrics.alert_rate", "alert_rate"), ("metrics.alert_count", "alert_count"),
             ("metrics.roc_auc", "roc_auc"), ("metrics.pr_auc", "average_precision")]
    return b.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(c).cast("double").alias("value"))
                                       for k, c in names])))


def monitor(current: DataFrame, reference: DataFrame | None, mode: str = "both", key: str = "txn_id",
            label: str = "Class", score: str = "score", batch_size: int = 200, alert_rate: float = 0.1,
            config: drift_ops.DriftConfig = drift_ops.DriftConfig()) -> DataFrame:
    """M3: evaluate (batched alert budget on the score), drift, or both, over
    one load; (metric, value) rows."""
    if mode not in {"evaluate", "drift", "both"}:
        raise ValueError("mode must be evaluate, drift or both")
    out = None
    if mode in {"evaluate", "both"}:
        b = split_ops.batches(current, key, batch_size)
        per = alert_ops.alert_budget_per_batch(b, score, key, alert_rate=alert_rate)
        ev = evaluate(per.withColumnRenamed("alert", "pred"), label, "pred", score)
        merged = alert_ops.merge_batches(alert_ops.batch_summaries(per.withColumn("alert", F.col("alert"))))
        extra = merged.select(F.inline(F.array(
            F.struct(F.lit("metrics.threshold_used").alias("metric"), F.col("threshold_used").cast("double").alias("value")),
            F.struct(F.lit("metrics.max_alerts").alias("metric"), F.col("max_alerts").cast("double").alias("value")),
            F.struct(F.lit("metrics.num_alerts").alias("metric"), F.col("num_alerts").cast("double").alias("value")))))
        out = ev.unionByName(extra)
    if mode in {"drift", "both"}:
        if reference is None:
            raise ValueError("drift needs reference data")
        cols = [c for c in current.columns if c != score]
        rep = drift_ops.drift_report(reference.select(*[c for c in cols if c in reference.columns]),
                                     current.select(*cols), config)
        d = drift_ops.drift_log_metrics(drift_ops.drift_summary(rep, config)).select(
            F.col("key").alias("metric"), "value")
        out = d if out is None else out.unionByName(d)
    return out


def promote(best: DataFrame, assets: DataFrame, run_metrics: DataFrame, metric: str,
            epsilon: float = 0.0, delta: float = 0.0, min_threshold: float | None = None,
            dry_run: bool = True, output: str | None = None, experiments: Sequence[str] = (), git_sha: str | None = None,
            force: bool = False) -> DataFrame:
    """M4: decide for every model name and, unless it is a dry run, add the
    registrations to the ledger ``output`` (J7); a repeated run adds nothing.
    ``force`` registers a candidate whose metric equals production's as staged.
    Returns the decisions."""
    named = assets.sparkSession.range(1).select(normalize_metric(F.lit(metric)).alias("m")).select("m.*").first()
    if not named["valid"]:
        raise ValueError(f"Unknown metric: {metric}")
    prod = reg.prod_metrics(assets, run_metrics, named["bare"])
    d = reg.decide(best, prod, epsilon, delta, min_threshold)
    if output and not dry_run:
        d = materialize(d)
        records = reg.promotion_records(d, experiments, reg.next_versions(assets), git_sha=git_sha, dry_run=False, force=force)
        reg.append_promotions(records, output)
    return d
