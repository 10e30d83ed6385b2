"""Registry and promotion over run / asset tables.

Decisions are one CASE over a candidate x production join, so many models
are decided in one job. Versions are compared as integer arrays (arrays
order lexicographically in Spark), non-numeric texts sorting below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.scalars import idempotency_key, parse_version
from vigil.operators.primitives import materialize

# Tag keys that may hold the producing run, in priority order,
# and tag keys that may hold the training data version.
RUN_ID_TAGS = ["run_id", "mlflow_run_id", "best_run_id"]
DATASET_VERSION_TAGS = ["dataset_version", "train_dataset_version", "data_version"]
# The fields of a promotion record and the tags of a registered model.
RECORD_FIELDS = [
    "metric", "metric_direction", "experiments", "best_run_id", "best_experiment_name", "best_metric_name", "best_metric_value",
    "prod_metric_value", "prod_model_name", "prod_model_version", "prod_run_id", "decision", "promote", "model_name",
    "model_version", "model_id", "dry_run"]
TAG_KEYS = [
    "experiment_name", "selected_metric", "metric_name", "metric_value", "best_run_id", "run_id", "git_sha", "idempotency_key",
    "promotion", "promotion_decision", "promotion_reason", "model_source", "dataset_version", "stage", "alias"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerance(epsilon: float = 0.0, delta: float = 0.0) -> float:
    return max(float(epsilon), float(delta))


def is_same(best: Column | str, current: Column | str, epsilon: float = 0.0, delta: float = 0.0) -> Column:
    """|a - b| <= tol, exact equality when tol <= 0."""
    tol = tolerance(epsilon, delta)
    b, c = _c(best), _c(current)
    return (b == c) if tol <= 0 else (F.abs(b - c) <= F.lit(tol))


def is_better(best: Column | str, current: Column | str, direction: Column | str,
              epsilon: float = 0.0, delta: float = 0.0) -> Column:
    """Strictly better by tol in the metric's direction."""
    tol = F.lit(tolerance(epsilon, delta))
    b, c, d = _c(best), _c(current), _c(direction)
    return F.when(d == "min", b < (c - tol)).otherwise(b > (c + tol))


def meets_min(value: Column | str, direction: Column | str, min_threshold: float | None = None) -> Column:
    """Floor in the metric's direction; no floor passes."""
    if min_threshold is None:
        return F.lit(True)
    v, d = _c(value), _c(direction)
    return F.when(d == "min", v <= F.lit(min_threshold)).otherwise(v >= F.lit(min_threshold))


def version_key(version: Column | str, tiebreak: Column | str | None = None) -> Column:
    """J8 order key: numeric versions above texts, then the int array, then
    text, then an optional unique tiebreak (so ties never pick at random)."""
    arr = parse_version(version)
    parts = [arr.isNotNull().alias("numeric"), arr.alias("parts"),
             F.lower(F.trim(_c(version).cast("string"))).alias("text")]
    if tiebreak is not None:
        parts.append(_c(tiebreak).alias("tiebreak"))
    return F.struct(*parts)


def int_version(version: Column | str) -> Column:
    """J8, integer variant: int(version) or 0."""
    return F.coalesce(F.trim(_c(version).cast("string")).try_cast("long"), F.lit(0))


def latest_versions(assets: DataFrame, name: str = "name", version: str = "version",
                    tiebreak: str | None = "asset_id") -> DataFrame:
    """The whole latest asset row for each name."""
    tb = tiebreak if tiebreak in assets.columns else None
    return assets.groupBy(name).agg(F.max_by(F.struct(*assets.columns), version_key(version, tb)).alias("a")) \
        .select("a.*")


def next_versions(assets: DataFrame, name: str = "name", version: str = "version",
                  base_version: str = "1.0") -> DataFrame:
    """Greatest numeric version with its last part + 1, else the base."""
    arr = parse_version(version)
    best = assets.groupBy(name).agg(F.max(arr).alias("_v"))
    bumped = F.concat(F.slice("_v", 1, F.size("_v") - 1), F.array(F.element_at("_v", -1) + 1))
    nxt = F.when(F.col("_v").isNull(), F.lit(base_version)).otherwise(
        F.array_join(F.transform(bumped, lambda x: x.cast("string")), "."))
    return best.select(name, nxt.alias("next_version"))


def run_of_tags(tags: Column | str) -> Column:
    """Producing run: first non-empty of the run-id tags."""
    t = _c(tags)
    return F.coalesce(*[F.nullif(F.element_at(t, k), F.lit("")) for k in RUN_ID_TAGS])


def dataset_version_of(tags: Column | str) -> Column:
    """First non-empty data version tag, else 'unknown'."""
    t = _c(tags)
    return F.coalesce(*[F.nullif(F.element_at(t, k), F.lit("")) for k in DATASET_VERSION_TAGS], F.lit("unknown"))


def prod_metrics(assets: DataFrame, run_metrics: DataFrame, metric: str) -> DataFrame:
    """For each model name, the latest version, its run and the run's
    value of ``metric`` (NULL when the run or the value is missing)."""
    latest = latest_versions(assets).select(F.col("name"), F.col("version").alias("prod_version"),
                                            run_of_tags("tags").alias("prod_run_id"))
    m = run_metrics.where(F.col("key") == metric).select(F.col("run_id").alias("prod_run_id"), "key",
                                                         F.col("value").alias("prod_value"))
    # taken from the data where there is any, so that the join in ``decide`` stays an equi-join
    return latest.join(m, "prod_run_id", "left").select("name", F.coalesce("key", F.lit(metric)).alias("metric"), "prod_version",
                                                        "prod_run_id", "prod_value")


def decide(candidate: DataFrame, prod: DataFrame, epsilon: float = 0.0, delta: float = 0.0,
           min_threshold: float | None = None, prod_model_name: str | None = None) -> DataFrame:
    """J4 + J7: candidate (metric, direction, run_id, metric_value) against
    every production model row (name, metric, prod_*) of the same metric: one
    decision per model (an equi-join on the metric name). Without a production
    model the candidate has one decision of its own, with a NULL name."""
    keys = ["name"] if "name" in candidate.columns else ["metric"]
    j = candidate.join(prod, keys, "left")
    meets = meets_min("metric_value", "direction", min_threshold)
    same = is_same("metric_value", "prod_value", epsilon, delta)
    better = is_better("metric_value", "prod_value", "direction", epsilon, delta)
    no_prod = F.col("prod_value").isNull()
    decision = (F.when(no_prod, F.when(meets, "promote").otherwise("stage"))
                .when(same, "skip").when(meets & better, "promote").otherwise("stage"))
    reason = (F.when(no_prod, F.when(meets, "no_prod_model").otherwise("below_min_threshold"))
              .when(same, "equal_metric").when(meets & better, "better_metric")
              .when(~meets, "below_min_threshold").otherwise("worse_metric"))
    out = j.withColumn("decision", decision).withColumn("reason", reason) \
        .withColumn("should_promote", F.col("decision") == "promote")
    target = F.lit(prod_model_name) if prod_model_name else F.col("name")
    return out.withColumn("model_name", F.when(F.col("decision") == "skip", F.lit(None).cast("string"))
                          .when(F.col("should_promote"), target)
                          .otherwise(F.concat(F.lit("model_"), F.col("run_id"))))


def promotion_records(decisions: DataFrame, experiments: Sequence[str], versions: DataFrame | None = None, dataset_version: Column | str | None = None,
                      git_sha: str | None = None, automl_experiment: str = "automl_train", dry_run: bool = True, force: bool = False) -> DataFrame:
    """The record of each decision (``RECORD_FIELDS``) with the ``tags`` of
    the model to register and its ``idempotency_key`` (B18).

    ``versions`` (name, next_version; see ``next_versions``) numbers the new
    models, first ones are 1. ``dataset_version`` is a text or a column of the
    decisions. Without a registration (a skip, unless ``force`` registers it as
    staged, or a dry run) version, id, tags and key are NULL.
    """
    d = decisions
    name = F.col("name") if "name" in d.columns else F.lit(None).cast("string")
    key = idempotency_key([F.coalesce("experiment_name", F.lit("")), "metric", "run_id"], F.lit(git_sha) if git_sha else None)
    forced = (F.col("decision") == "skip") & F.lit(force)
    d = d.withColumns({"_prod": name, "_forced": forced, "_target": F.when(forced, F.concat(F.lit("model_"), F.col("run_id"))).otherwise(F.col("model_name"))})
    if versions is not None:
        v = versions.select(F.col("name").alias("_vn"), F.col("next_version").alias("_nv"))
        d = d.join(v, d["_target"] == v["_vn"], "left").drop("_vn")
    else:
        d = d.withColumn("_nv", F.lit(None).cast("string"))
    registers = F.lit(not dry_run) & ((F.col("decision") != "skip") | F.col("_forced"))
    stage = F.when(F.col("should_promote"), "production").otherwise("staging")
    version = F.when(registers, F.coalesce("_nv", F.lit("1")))
    data = _c(dataset_version) if isinstance(dataset_version, Column) else F.lit(dataset_version or "unknown")
    values = {
        "experiment_name": F.col("experiment_name"), "selected_metric": F.col("metric"), "metric_name": F.col("metric"),
        "metric_value": F.col("metric_value").cast("string"), "best_run_id": F.col("run_id"), "run_id": F.col("run_id"),
        "git_sha": F.lit(git_sha or "unknown"), "idempotency_key": key, "promotion": F.col("should_promote").cast("string"),
        "promotion_decision": F.col("decision"), "promotion_reason": F.col("reason"),
        "model_source": F.when(F.col("experiment_name") == automl_experiment, "automl").otherwise("custom"),
        "dataset_version": data, "stage": stage, "alias": stage}
    tags = F.create_map(*[x for k in TAG_KEYS for x in (F.lit(k), values[k])])
    fields = {
        "metric": F.col("metric"), "metric_direction": F.col("direction"), "experiments": F.array(*[F.lit(e) for e in experiments]).cast("array<string>"),
        "best_run_id": F.col("run_id"), "best_experiment_name": F.col("experiment_name"), "best_metric_name": F.col("metric"), "best_metric_value": F.col("metric_value"),
        "prod_metric_value": F.col("prod_value"), "prod_model_name": F.col("_prod"), "prod_model_version": F.col("prod_version"), "prod_run_id": F.col("prod_run_id"),
        "decision": F.col("decision"), "promote": F.col("should_promote"), "model_name": F.col("_target"), "model_version": version,
        "model_id": F.when(registers, F.concat(F.col("_target"), F.lit(":"), version)), "dry_run": F.lit(dry_run)}
    return d.select(*[fields[f].alias(f) for f in RECORD_FIELDS], F.when(registers, tags).alias("tags"), F.when(registers, key).alias("idempotency_key"))


def append_promotions(records: DataFrame, path: str) -> DataFrame:
    """Add the registrations among ``records`` to the ledger at ``path`` (Parquet) and return what was added.

    A registration is known by its idempotency key and model name: one that the
    ledger has is not added again, so a run can be repeated; of several new ones
    the record against the first production model (by name) is taken.
    Records without a registration (dry runs, skips) write nothing. One writer at
    a time.
    """
    spark = records.sparkSession
    new = (records.where(F.col("idempotency_key").isNotNull()).groupBy("idempotency_key", "model_name")
           .agg(F.min_by(F.struct(*records.columns), F.struct("prod_model_name", "decision")).alias("_r")).select("_r.*"))
    try:
        known = spark.read.schema(records.schema).parquet(path).select("idempotency_key", "model_name")
        new = new.join(known, ["idempotency_key", "model_name"], "left_anti").select(*records.columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    new = materialize(new)  # read from the ledger before it is written
    if not new.isEmpty():
        new.write.mode("append").parquet(path)
    return new
