"""Training, selection and scoring on ``pyspark.ml``.

Boosted trees are MLlib's ``GBTClassifier`` (depth-wise growth, logistic
loss, row subsampling). ``fit_with_patience`` stops early by patience on
average precision; ``fit`` alone stops on MLlib's validation loss. Differences
from the histogram boosters the survey names are documented in the README: no
leaf-wise growth, no L1/L2 on leaves, ``stepSize`` limited to (0, 1].

Model quality is always measured with the tie-exact AP / ROC-AUC of
``vigil.operators.metrics`` (a Spark job), never with a local library.
"""

from __future__ import annotations

import math
import random
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Bucketizer, ElementwiseProduct, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.operators import boost
from vigil.operators import metrics as met
from vigil.operators.primitives import _null_safe, finite, global_rank, materialize
from vigil.operators.scale import with_weights

# The boosted-tree settings the reference trains with (XGBoost
# variant: depth 5, learning rate 0.05, row/column sampling 0.8, patience 50,
# at most 2000 rounds; LightGBM variant: 63 leaves, at most 5000 rounds).
XGB_DEFAULTS = {"maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
                "maxIter": 2000}
LGBM_DEFAULTS = {"maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
                 "maxIter": 5000, "minInstancesPerNode": 20}
# The most trials that the reference's sweep starts, and how many of them run at once.
SEARCH_TRIALS, SEARCH_PARALLEL = 300, 3
# Rounds without a better validation AP after which boosting ends.
PATIENCE = 50
# Rounds that are ranked in one job.
STAGED = 32
# A larger training table is summed up by its bins before it is boosted.
BINNED_ROWS = 500_000
# A feature with at most so many values has a bin for each of them.
EVERY_VALUE = 64
# Estimators that see a feature only by its bins.
TREES = (GBTClassifier, RandomForestClassifier, DecisionTreeClassifier)
# Folds that are fitted at once on such a table.
FOLDS_PARALLEL = 5


@dataclass
class TrainResult:
    model: PipelineModel
    features: list[str]
    label: str
    metrics: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def positive_probability(scored: DataFrame, col: str = "p_hat") -> DataFrame:
    """Probability of class 1 from an MLlib probability vector."""
    return scored.withColumn(col, vector_to_array("probability")[1])


class APEvaluator(Evaluator):
    """Tie-exact average precision (or ROC-AUC) as an MLlib Evaluator, so
    tuning utilities rank models by the same metric as reports."""

    def __init__(self, labelCol: str = "label", metric: str = "average_precision"):
        super().__init__()
        self.labelCol = labelCol
        self.metric = metric

    def _evaluate(self, dataset: DataFrame) -> float:
        counted = [c for c in ("_n",) if c in dataset.columns]  # summed rows (``binned``)
        d = positive_probability(dataset).select(F.col(self.labelCol).alias("_y"), "p_hat", *counted)
        c = met.curve(d, "_y", "p_hat", count="_n" if counted else None)
        res = met.average_precision(c) if self.metric == "average_precision" else met.roc_auc(c)
        v = res.first()[0]
        return float(v) if v is not None else float("nan")

    def isLargerBetter(self) -> bool:
        return True


def gbt(params: dict | None = None, label: str = "Class", weight: str | None = "weight",
        validation: str | None = "is_val", variant: str = "xgb") -> GBTClassifier:
    """A boosted-tree estimator with the variant's defaults."""
    p = dict(XGB_DEFAULTS if variant == "xgb" else LGBM_DEFAULTS)
    p.update(params or {})
    if not 0.0 < float(p["stepSize"]) <= 1.0:
        raise ValueError(f"stepSize must be above 0 and at most 1, not {p['stepSize']}")
    if weight:
        p["weightCol"] = weight
    if validation:
        p["validationIndicatorCol"] = validation
        p["validationTol"] = 1e-4
    return GBTClassifier(labelCol=label, featuresCol="features", seed=42, lossType="logistic", **p)


def binning(df: DataFrame, features: Sequence[str], bins: int) -> list:
    """Stages that give ``features`` as the bin of each feature, from all rows of ``df``.

    Cuts lie between all values of a feature that has at most ``EVERY_VALUE``
    (the estimator merges them by its own rule, as it does with the values),
    and otherwise at ``bins`` - 1 quantiles. Missing values are an error, as
    MLlib has it; when a row is scored they lie behind all others, as there.
    """
    cast = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    near = cast.agg(*[F.approx_count_distinct(f).alias(f) for f in features], *[F.count_if(~finite(f)).alias(f"_x_{f}") for f in features]).first()
    if lost := [f for f in features if near[f"_x_{f}"]]:
        raise ValueError(f"Features with missing or infinite values cannot be trained on: {lost}.")
    few = [f for f in features if near[f] <= EVERY_VALUE]
    sets = cast.agg(*[F.collect_set(f).alias(f) for f in few]).first() if few else {}  # at most about EVERY_VALUE each
    many = [f for f in features if f not in few]
    probs = [i / bins for i in range(1, bins)]
    at = dict(zip(many, cast.approxQuantile(many, probs, 0.1 / bins))) if many else {}
    splits = []
    for f in features:
        v = sorted({x for x in (sets[f] if f in few else at[f]) if math.isfinite(x)})
        cuts = sorted({a + (b - a) / 2 for a, b in zip(v, v[1:])}) if f in few else v
        splits.append([-math.inf, *(cuts or [0.0]), math.inf])
    names = [f"_bin_{f}" for f in features]
    # the product with ones leaves Bucketizer's mark behind, by which trees would take ordered bins for categories
    return [Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=names, handleInvalid="keep"),
            VectorAssembler(inputCols=names, outputCol="_bins", handleInvalid="keep"),
            ElementwiseProduct(scalingVec=Vectors.dense([1.0] * len(names)), inputCol="_bins", outputCol="features")]


def binned(df: DataFrame, stages: list, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """The rows of each bin and ``keys`` as one row: their number ``_n`` and their weights' sum ``_w``.

    Every row counts. Subsampling draws such rows, so where they would be few
    the rows of a bin are dealt over several of them.
    """
    names = stages[0].getOutputCols()
    placed = stages[0].transform(df).select(*names, *keys, (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w"))

    def summed(*more: str) -> DataFrame:
        return materialize(placed.groupBy(*names, *keys, *more).agg(F.sum("_w").alias("_w"), F.count(F.lit(1)).alias("_n")))

    out = summed()
    parts = BINNED_ROWS // max(out.count(), 1)
    if parts > 1:
        placed = placed.withColumn("_part", F.monotonically_increasing_id() % parts)
        out = summed("_part").drop("_part")
    return PipelineModel(stages[1:]).transform(out).drop("_bins")


def _may_bin(estimator, rows: int) -> bool:
    """Bins serve trees on many rows; a least number of rows in a node needs the rows themselves."""
    return isinstance(estimator, TREES) and estimator.getMinInstancesPerNode() == 1 and rows > BINNED_ROWS


def _bins_of(train: DataFrame, features: Sequence[str], estimator: GBTClassifier, label: str) -> tuple[list, DataFrame]:
    """The bins that ``estimator`` wants, from the rows it may learn from, and all rows summed by them."""
    marked = estimator.isSet("validationIndicatorCol")
    flag = [estimator.getValidationIndicatorCol()] if marked else []
    stages = binning(train.where(~F.col(flag[0])) if marked else train, features, estimator.getMaxBins())
    weight = estimator.getWeightCol() if estimator.isSet("weightCol") else None
    return stages, binned(train, stages, [label, *flag], weight)


def boosted(estimator: GBTClassifier, table: DataFrame) -> GBTClassificationModel:
    """``estimator`` fitted to a table of summed rows (``binned``): in one task while it has at most
    ``boost.GROWN_ROWS`` of them, otherwise by MLlib's jobs."""
    estimator = estimator.copy({estimator.weightCol: "_w"})
    if boost.can_grow(estimator, table.count()):
        return boost.as_model(estimator, table, boost.grow(estimator, table))
    table = table.persist()  # every round reads the marked rows again
    try:
        return estimator.fit(table)
    finally:
        table.unpersist()


def fit(train: DataFrame, features: Sequence[str], estimator, label: str = "Class") -> TrainResult:
    """Fit assembler + estimator; early stopping (if any) uses the
    validation indicator column of ``train``. Boosted trees see a feature only by
    its bins, so the rows of a large table that share all bins, the label and
    the indicator are boosted as one row with the sum of their weights."""
    if not (isinstance(estimator, GBTClassifier) and _may_bin(estimator, train.count())):
        return TrainResult(Pipeline(stages=[assembler(features), estimator]).fit(train), list(features), label)
    stages, table = _bins_of(train, features, estimator, label)
    return TrainResult(PipelineModel([*stages, boosted(estimator, table)]), list(features), label)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., p_hat)."""
    return positive_probability(model.transform(df)).select(*keep, "p_hat")


def score_sums(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., p_hat, _n): ``score`` of all rows, with the number of rows that each row stands for.

    A model on bins gives rows of the same bins the same score, so each set of
    bins goes through its trees once, however many rows, copies and groups have it."""
    first = model.stages[0]
    if not isinstance(first, Bucketizer):
        return score(model, df, keep).withColumn("_n", F.lit(1).cast("long"))
    names = first.getOutputCols()
    sums = materialize(first.transform(df).groupBy(*names, *keep).agg(F.count(F.lit(1)).alias("_n")))
    sets = sums.select(*names).distinct()
    each = boost.probabilities(model.stages[-1], sets) if hasattr(model.stages[-1], "grown") else score(PipelineModel(model.stages[1:]), sets, names)
    # a missing value has no bin
    return _null_safe(sums, each, names, "inner").select(*keep, "p_hat", "_n")


def evaluate(scored: DataFrame, label: str = "Class", score_col: str = "p_hat",
             group: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """AP and ROC-AUC of scored rows (per group). ``count`` names how many rows each row stands for."""
    c = met.curve(scored, label, score_col, group=list(group) or None, count=count)
    # one row for each group
    return _null_safe(met.average_precision(c, group), met.roc_auc(c, group), list(group), "inner") if group else \
        met.average_precision(c).withColumn("roc_auc", met.roc_auc(c).scalar())


def sample_grid(space: dict, n_trials: int, seed: int = 42) -> list[dict]:
    """I4: seeded random draws from a space of ('uniform', lo, hi) / ('choice', [..]) entries."""
    rng = random.Random(seed)
    out = []
    for _ in range(n_trials):
        t = {}
        for k, spec in space.items():
            if spec[0] == "uniform":
                t[k] = rng.uniform(spec[1], spec[2])
            elif spec[0] == "quniform":
                t[k] = int(round(rng.uniform(spec[1], spec[2])))
            else:
                t[k] = rng.choice(list(spec[1]))
        out.append(t)
    return out


def random_search(train: DataFrame, valid: DataFrame, features: Sequence[str], space: dict,
                  n_trials: int = SEARCH_TRIALS, label: str = "Class", seed: int = 42, base: dict | None = None,
                  parallelism: int = SEARCH_PARALLEL, time_limit: float | None = None) -> DataFrame:
    """I4: at most ``n_trials`` trials, ``parallelism`` of them at a time on one prepared table.

    Each trial is one fit, stopped early on ``valid``, and one Spark evaluation
    on it. Settings that neither ``base`` nor ``space`` names are the variant's
    defaults. After ``time_limit`` seconds no further trial starts; those that
    run are finished. A large table is summed by its bins once, for all trials
    (``fit``). Returns (trial, params, average_precision, roc_auc) of the
    finished trials, the best one first."""
    spark = train.sparkSession
    marked = materialize(train.withColumn("is_val", F.lit(False)).unionByName(valid.withColumn("is_val", F.lit(True))))
    held = marked.where("is_val")
    weight = "weight" if "weight" in train.columns else None
    started = time.monotonic()
    draws = sample_grid(space, n_trials, seed)
    rows, summed = marked.count(), {}  # by the number of bins

    def trial(number: int, drawn: dict) -> tuple | None:
        if time_limit is not None and time.monotonic() - started >= time_limit:
            return None
        params = {**(base or {}), **drawn}
        estimator = gbt(params, label=label, weight=weight)
        if _may_bin(estimator, rows):
            table = summed[estimator.getMaxBins()]
            scored = score(boosted(estimator, table), table.where("is_val"), [label, "_n"])
        else:
            scored = score(fit(marked, features, estimator, label).model, held, [label])
        ev = evaluate(scored, label, count="_n" if "_n" in scored.columns else None).first()
        return number, str(sorted(params.items())), ev["average_precision"], ev["roc_auc"]

    for drawn in draws:
        estimator = gbt({**(base or {}), **drawn}, label=label, weight=weight)
        if _may_bin(estimator, rows) and estimator.getMaxBins() not in summed:
            summed[estimator.getMaxBins()] = _bins_of(marked, features, estimator, label)[1]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(trial), k, p) for k, p in enumerate(draws)]
        done = [r for job in jobs if (r := job.result()) is not None]
    done.sort(key=lambda r: (-(r[2] if r[2] is not None else -1.0), r[0]))
    return spark.createDataFrame(done, "trial int, params string, average_precision double, roc_auc double")


@dataclass
class PatientFit:
    result: TrainResult
    best_round: int
    #: (round, average_precision) of every round that was looked at
    rounds: DataFrame


def staged_ap(trees: Sequence, weights: Sequence[float], data: DataFrame, label: str, after: int = 0, margin: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(round, average_precision) on ``data`` (with features) after each of the trees, which come behind the ``after`` ones that made ``margin``.

    Each tree is evaluated once and all rounds are ranked in one grouped job.
    Also returns ``data`` with the new margin, to go on from.
    """
    now = data.withColumn("_m", F.col(margin) if margin else F.lit(0.0))
    if "_n" not in now.columns:
        now = now.withColumn("_n", F.lit(1).cast("long"))
    for k, tree in enumerate(trees):
        now = tree.setPredictionCol(f"_t{k}").transform(now)
    steps, total = [], F.col("_m")
    for k, w in enumerate(weights):
        total = total + F.lit(float(w)) * F.col(f"_t{k}")
        steps.append(total)
    long = now.select(F.col(label), "_n", F.posexplode(F.array(*steps)).alias("_k", "_s")).withColumn("round", F.col("_k") + F.lit(after + 1))
    ap = met.average_precision(met.curve(long, label, "_s", group="round", count="_n"), ["round"])
    return ap, now.withColumn("_margin", total).drop("_m", *[f"_t{k}" for k in range(len(trees))])


def fit_with_patience(train: DataFrame, features: Sequence[str], params: dict | None = None, label: str = "Class", variant: str = "xgb",
                      validation: str = "is_val", patience: int = PATIENCE, first_rounds: int | None = None) -> PatientFit:
    """Boosting with early stopping by patience on validation average precision.

    Rounds are added until ``patience`` of them in a row did not better the
    best AP on the rows that ``validation`` marks, or the variant's most rounds
    are reached; the model of the best round (the first of equal ones) is kept.
    MLlib cannot go on from a model, but a fit with more rounds begins with the
    same trees; so rounds are doubled from ``first_rounds`` (patience and a
    third more), and only new trees are scored. The trees of a summed table
    (``boosted``) go on from those before; such a table also tells how many rows
    a node has, so a least number of them does not need the rows themselves.
    """
    weight = "weight" if "weight" in train.columns else None
    most = gbt(params, label=label, variant=variant).getOrDefault("maxIter")
    fitted, marked = train.where(~F.col(validation)), train.where(F.col(validation))
    estimator = gbt(params, label=label, weight=weight, validation=None, variant=variant)
    stages, alone = None, False
    if fitted.count() > BINNED_ROWS:
        bins = binning(fitted, features, estimator.getMaxBins())
        grown = binned(fitted, bins, [label], weight)
        alone = boost.can_grow(estimator, grown.count())
        if alone or _may_bin(estimator, BINNED_ROWS + 1):
            stages, weight, held = bins, "_w", binned(marked, bins, [label])
            grown = grown if alone else materialize(grown)
    if stages is None:
        stages = [assembler(features)]
        grown, held = materialize(stages[0].transform(fitted)), stages[0].transform(marked).withColumn("_n", F.lit(1).cast("long"))
    held = materialize(held.select(label, "_n", "features"))

    def fitted_to(n: int):
        return gbt({**(params or {}), "maxIter": n}, label=label, weight=weight, validation=None, variant=variant)

    rounds, seen = min(most, first_rounds or patience + patience // 3), []
    margin, done, nodes = None, 0, []
    while True:
        if alone:
            nodes = boost.grow(fitted_to(rounds), grown, nodes)
        model = boost.as_model(fitted_to(rounds), grown, nodes) if alone else fitted_to(rounds).fit(grown)
        trees, weights = model.trees, list(model.treeWeights)
        while done < rounds:
            upto = min(done + STAGED, rounds)
            ap, held = staged_ap(trees[done:upto], weights[done:upto], held, label, done, margin)
            held, margin = materialize(held.select(label, "_n", "features", "_margin")), "_margin"
            seen += [(r["round"], r["average_precision"]) for r in ap.collect()]
            done = upto
            best = min(seen, key=lambda x: (-(x[1] if x[1] is not None else -1.0), x[0]))[0]
            if done - best >= patience:
                break
        if done - best >= patience or rounds >= most:
            break
        rounds = min(most, 2 * rounds)
    kept = model if best == rounds else boost.as_model(fitted_to(best), grown, nodes[:best]) if alone else fitted_to(best).fit(grown)
    pipeline = PipelineModel([*stages, kept])
    table = train.sparkSession.createDataFrame(sorted(seen), "round int, average_precision double")
    return PatientFit(TrainResult(pipeline, list(features), label, {"best_round": best}, dict(params or {})), best, table)


def model_selection(df: DataFrame, features: Sequence[str], label: str = "Class", fold_col: str = "fold",
                    algorithms: Sequence[str] | None = None, parallelism: int = 2, k: int = 5) -> DataFrame:
    """K-fold cross-validation (folds from D4 via ``fold_col``) over several
    algorithms; the primary metric is tie-exact AP. One row per algorithm.

    ``parallelism`` folds are under way at a time. Trees learn a large table from
    its bins, cut on a fold's own training rows (``fit``). The mean over the folds
    is all that is returned, so no model is fitted on all of them."""
    spark = df.sparkSession
    algos = {
        "logistic_regression": LogisticRegression(labelCol=label, maxIter=50),
        "random_forest": RandomForestClassifier(labelCol=label, numTrees=20, maxDepth=5, seed=42),
        "gbt": GBTClassifier(labelCol=label, maxIter=20, maxDepth=3, seed=42),
        "decision_tree": DecisionTreeClassifier(labelCol=label, maxDepth=5, seed=42),
    }
    names = [a for a in (algorithms or ["logistic_regression", "random_forest", "gbt"]) if a in algos]
    # every fold and algorithm reads these columns, and only these
    rows = df.select(label, fold_col, *features).persist()
    sizes = {r[fold_col]: r["count"] for r in rows.groupBy(fold_col).count().collect()}
    if set(sizes) != set(range(k)):
        rows.unpersist()
        raise ValueError(f"Folds must be 0 to {k - 1}, each with rows, not {sorted(sizes, key=str)}.")
    evaluator, plain = APEvaluator(label), assembler(features)

    def tried(f: int) -> list[float]:
        """AP of each algorithm on the fold that it has not seen."""
        train, held = rows.where(F.col(fold_col) != f), rows.where(F.col(fold_col) == f)
        summed, out = {}, []  # by the number of bins
        for estimator in (algos[name] for name in names):
            if _may_bin(estimator, sum(sizes.values()) - sizes[f]):
                if (bins := estimator.getMaxBins()) not in summed:
                    stages = binning(train, features, bins)
                    summed[bins] = binned(train, stages, [label]), binned(held, stages, [label])
                learnt, judged = summed[bins]
                weighted = estimator.copy({estimator.weightCol: "_w"})
                model = boosted(estimator, learnt) if isinstance(estimator, GBTClassifier) else weighted.fit(learnt)
            else:
                judged = plain.transform(held)
                model = estimator.fit(plain.transform(train))
            out.append(evaluator.evaluate(model.transform(judged)))
        return out

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            found = list(pool.map(inheritable_thread_target(spark)(tried), range(k)))
    finally:
        rows.unpersist()
    out = [(name, sum(aps) / k) for name, aps in zip(names, zip(*found))]
    res = spark.createDataFrame(out, "algorithm string, cv_average_precision double")
    # one row per algorithm: a bounded table
    return res.withColumn("rank", F.dense_rank().over(Window.orderBy(F.desc("cv_average_precision"))))


def fold_scores(df: DataFrame, features: Sequence[str], label: str = "Class", fold_col: str = "fold",
                k: int = 5, params: dict | None = None) -> tuple[DataFrame, list[TrainResult]]:
    """For each fold, train on the others and report AP / ROC-AUC on it.
    Rows of the other folds that ``is_val`` marks (if there is such a column)
    stop the rounds early; without it all rounds are run. All folds'
    validation scores are evaluated in one grouped job."""
    fitted = F.lit(True) if "is_val" not in df.columns else ~F.col("is_val")
    # at most two rows for each fold
    n = {(r["f"], r["y"]): r["count"] for r in df.where(fitted).groupBy(F.col(fold_col).alias("f"), (F.col(label) == 1).alias("y")).count().collect()}

    def without(f: int) -> TrainResult:
        tr = df.where(F.col(fold_col) != f)
        if "weight" in df.columns:  # the class weight of this fold's own training rows
            pos, neg = (sum(c for (g, y), c in n.items() if g is not None and g != f and y is hit) for hit in (True, False))
            tr = with_weights(tr, neg / max(pos, 1), label)
        return fit(tr, features, gbt(params, label=label, weight="weight" if "weight" in df.columns else None,
                                     validation="is_val" if "is_val" in df.columns else None), label)

    # a fold's jobs are many and short
    with ThreadPoolExecutor(max_workers=FOLDS_PARALLEL if sum(n.values()) > BINNED_ROWS else 1) as pool:
        results = list(pool.map(inheritable_thread_target(df.sparkSession)(without), range(k)))
    scored = None
    for f, r in enumerate(results):
        s = score_sums(r.model, df.where(F.col(fold_col) == f), [label, fold_col])
        scored = s if scored is None else scored.unionByName(s)
    return evaluate(scored, label, group=[fold_col], count="_n"), results


def permutation_drops(models: dict, valid: DataFrame, features: Sequence[str], key: str, group_col: str,
                      label: str = "Class", n_repeats: int = 5, seed: int = 42) -> DataFrame:
    """I7 + D7: (group, feature, repeat, drop): how much a group's AP under its own model falls when one feature is shuffled within the group.

    Row i of one md5 order of the keys takes the values of row i of another,
    salted by the repeat. Two distributed ranks and one join serve every feature
    and repeat: the shuffled row is carried beside the row, and only then copied
    for each feature. All copies are ranked in one grouped job.
    """
    g = group_col
    salt = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    a = global_rank(valid.select(g, key, label, *features).withColumn("_pa", F.md5(F.concat_ws(":", salt, F.lit("perm-a")))), "_pa", group=g,
                    rank_col="_ra").drop("_pa", key)
    rep_ids = F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))).alias("repeat")
    vb = valid.select(g, key, *features, rep_ids).withColumn("_pb", F.md5(F.concat_ws(":", salt, F.lit("perm-b"), F.col("repeat").cast("string"))))
    b = global_rank(vb, "_pb", group=[g, "repeat"], rank_col="_rb").select(
        F.col(g).alias("_g"), "repeat", "_rb", *[F.col(f).alias(f"_p{i}") for i, f in enumerate(features)])
    pairs = a.join(b, a[g].eqNullSafe(F.col("_g")) & (F.col("_ra") == F.col("_rb")))
    each = [F.struct(F.lit(f).alias("feature"), *[F.col(f"_p{k}" if k == i else h).cast("double").alias(h) for k, h in enumerate(features)]) for i, f in enumerate(features)]
    # the row as it is comes once, as the group's own AP
    plain = F.when(F.col("repeat") == 0, F.struct(F.lit(None).cast("string").alias("feature"), *[F.col(h).cast("double").alias(h) for h in features]))
    # rows are kept with their shuffled ones, and copied only where they are scored
    pairs = materialize(pairs.select(g, label, "repeat", *features, *[f"_p{i}" for i in range(len(features))]))
    scored = None
    for value, model in models.items():
        mine = pairs.where(F.col(g).eqNullSafe(F.lit(value)))
        copies = mine.select(g, label, "repeat", F.explode(F.array_compact(F.array(plain, *each))).alias("c")).select(g, label, "repeat", "c.*")
        s = score_sums(model, copies, [g, label, "feature", "repeat"])
        scored = s if scored is None else scored.unionByName(s)
    by = [g, "feature", "repeat"]
    ap = materialize(met.average_precision(met.curve(scored, label, "p_hat", group=by, count="_n"), by))
    base = ap.where("feature IS NULL").select(F.col(g).alias("_g"), F.col("average_precision").alias("_base"))  # one row for each model
    shuffled = ap.where("feature IS NOT NULL")
    return shuffled.join(base, shuffled[g].eqNullSafe(F.col("_g"))).select(g, "feature", "repeat", (F.col("_base") - F.col("average_precision")).alias("drop"))


def permutation_importance(model: PipelineModel, valid: DataFrame, features: Sequence[str], key: str,
                           label: str = "Class", n_repeats: int = 5, seed: int = 42) -> DataFrame:
    """I7 of one model: (feature, importance_mean, importance_std) over the repeats."""
    drops = permutation_drops({0: model}, valid.withColumn("_grp", F.lit(0)), features, key, "_grp", label, n_repeats, seed)
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))


def fold_permutation_importance(results: Sequence[TrainResult], folds: DataFrame, key: str, fold_col: str = "fold",
                                n_repeats: int = 5, seed: int = 42) -> DataFrame:
    """I7 per fold: (feature, fold, importance), each fold's model on the fold it has not seen, the mean over the repeats. Feeds F24."""
    first = results[0]
    drops = permutation_drops({f: r.model for f, r in enumerate(results)}, folds, first.features, key, fold_col, first.label, n_repeats, seed)
    return drops.groupBy("feature", fold_col).agg(F.avg("drop").alias("importance"))


def fold_importance_summary(per_fold: DataFrame, top: int = 30) -> DataFrame:
    """per feature mean, sample std and cv = std / (|mean| + 1e-12) of
    per-fold importances; rank by mean (descending), flag the top ones, and
    among these rank the most unstable (largest cv) first."""
    s = per_fold.groupBy("feature").agg(F.avg("importance").alias("mean_importance"),
                                        F.stddev_samp("importance").alias("std_importance"))
    s = s.withColumn("cv", F.col("std_importance") / (F.abs("mean_importance") + 1e-12))
    # one row per feature: a bounded table
    w = Window.orderBy(F.desc("mean_importance"), "feature")
    s = s.withColumn("rank", F.row_number().over(w)).withColumn("in_top", F.col("rank") <= top)
    unstable = F.row_number().over(Window.partitionBy("in_top").orderBy(F.desc("cv"), "feature"))
    return s.withColumn("unstable_rank", F.when(F.col("in_top"), unstable))


def feature_importances(result: TrainResult) -> DataFrame:
    """I8: model importances ranked, with feature names."""
    tree = result.model.stages[-1]
    imp = tree.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    rows = sorted(zip(result.features, imp), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def platt(scored: DataFrame, label: str = "Class", score_col: str = "score") -> tuple[float, float]:
    """Sigmoid calibration a * s + b of a frozen score, fitted by
    logistic regression on Platt's smoothed targets (two weighted rows each)."""
    rows = met.platt_training_rows(scored, label, score_col)
    data = VectorAssembler(inputCols=["s"], outputCol="features").transform(rows)
    lr = LogisticRegression(labelCol="target", weightCol="w", regParam=0.0, maxIter=100,
                            standardization=False).fit(data)
    return float(lr.coefficients[0]), float(lr.intercept)


def apply_platt(df: DataFrame, a: float, b: float, score_col: str = "score", out: str = "calibrated") -> DataFrame:
    return df.withColumn(out, 1 / (1 + F.exp(-(F.lit(a) * F.col(score_col) + F.lit(b)))))


def save_bundle(result: TrainResult, path: str, metadata: dict) -> DataFrame:
    """The pipeline model plus a one-row metadata table next to it
    (features and label always carried, fixing trap T11)."""
    spark = SparkSession.getActiveSession()
    result.model.write().overwrite().save(path + "/model")
    meta = {"features": list(result.features), "label_column": result.label, **metadata}
    items = [(k, str(v)) for k, v in meta.items()]
    md = spark.createDataFrame(items, "key string, value string")
    md.coalesce(1).write.mode("overwrite").json(path + "/metadata")
    return md


def run_record(run_id: str, experiment: str, params: dict, metrics: dict, tags: dict) -> tuple[DataFrame, ...]:
    """Rows for the runs, run_params and run_metrics tables."""
    spark = SparkSession.getActiveSession()
    runs = spark.createDataFrame([(run_id, experiment, "FINISHED", tags)],
                                 "run_id string, experiment_name string, status string, tags map<string,string>")
    p = spark.createDataFrame([(run_id, k, str(v)) for k, v in params.items()],
                              "run_id string, key string, value string")
    m = spark.createDataFrame([(run_id, k, float(v)) for k, v in metrics.items() if v is not None],
                              "run_id string, key string, value double")
    return runs, p, m


