"""Column-level helpers (B7-B21). Each returns a Column expression that stays
inside whole-stage codegen; none launches a job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's): accepted boolean spellings.
TRUE_VALUES = ["true", "1", "yes", "y"]
FALSE_VALUES = ["false", "0", "no", "n"]

# Metric keys the run records may carry, and name aliases.
CANONICAL_METRIC_KEYS = [
    "metrics.weighted_accuracy",
    "metrics.AUC_micro",
    "metrics.precision_score_weighted",
    "metrics.f1_score_macro",
    "metrics.norm_macro_recall",
    "metrics.average_precision_score_weighted",
    "metrics.AUC_macro",
    "metrics.f1_score_micro",
    "metrics.recall_score_macro",
    "metrics.recall_score_micro",
    "metrics.precision_score_micro",
    "metrics.AUC_weighted",
    "metrics.log_loss",
    "metrics.average_precision_score_macro",
    "metrics.f1_score_weighted",
    "metrics.precision_score_macro",
    "metrics.average_precision_score_micro",
    "metrics.recall_score_weighted",
    "metrics.matthews_correlation",
    "metrics.accuracy",
    "metrics.balanced_accuracy",
]
METRIC_ALIASES = {
    "average_precision": "metrics.average_precision_score_macro",
    "average_precision_score": "metrics.average_precision_score_macro",
    "average_precision_score_macro": "metrics.average_precision_score_macro",
    "average_precision_score_weighted": "metrics.average_precision_score_weighted",
    "average_precision_score_micro": "metrics.average_precision_score_micro",
    "roc_auc": "metrics.AUC_macro",
    "auc": "metrics.AUC_macro",
    "auc_macro": "metrics.AUC_macro",
    "auc_weighted": "metrics.AUC_weighted",
    "auc_micro": "metrics.AUC_micro",
    "accuracy": "metrics.accuracy",
    "balanced_accuracy": "metrics.balanced_accuracy",
}
# Substrings that make a metric "lower is better".
MIN_DIRECTION_MARKERS = ["loss", "error", "rmse", "mae"]

# Text that pandas' to_numeric would accept (and DuckDB's TRY_CAST too);
# Spark's own cast also takes '3f' / '4d' suffixes, which we refuse.
NUMERIC_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Coerce to double, invalid -> NULL, NaN -> NULL."""
    c = _c(c)
    if dtype is not None and isinstance(dtype, (T.NumericType, T.BooleanType)):
        v = c.cast("double")
    else:
        s = c.cast("string")
        v = F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))
    # nanvl evaluates v once; NaN becomes NULL.
    return F.nanvl(v, F.lit(None).cast("double"))


def coerce_label(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Invalid or NULL -> 0, otherwise truncated to int."""
    return F.coalesce(to_number(c, dtype).try_cast("int"), F.lit(0))


def is_missing(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """NULL, or NaN for floating columns."""
    c = _c(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def threshold_label(p: Column | str, t: float | Column) -> Column:
    """1 when p >= t; NaN never alerts."""
    p = _c(p)
    return F.when(~F.isnan(p) & (p >= t), 1).otherwise(0)


def parse_bool(text: Column | str) -> Column:
    """struct(value, reason). NULL text (no flag) counts as true."""
    t = _c(text)
    n = F.lower(F.trim(t))
    return (F.when(t.isNull(), F.struct(F.lit(True).alias("value"), F.lit(None).cast("string").alias("reason")))
            .when(n.isin(TRUE_VALUES), F.struct(F.lit(True).alias("value"), F.lit(None).cast("string").alias("reason")))
            .when(n.isin(FALSE_VALUES), F.struct(F.lit(False).alias("value"), F.lit("validation flag false").alias("reason")))
            .otherwise(F.struct(F.lit(False).alias("value"),
                                F.concat(F.lit("unexpected is_valid value: '"), F.trim(t), F.lit("'")).alias("reason"))))


def normalize_metric(name: Column | str) -> Column:
    """struct(bare, full, valid): strip ``metrics.``, map aliases
    (case-folded), check against the canonical list."""
    raw = F.trim(_c(name))
    bare = F.when(raw.startswith("metrics."), F.substring(raw, 9, 1 << 20)).otherwise(raw)
    alias_map = F.create_map(*[x for k, v in METRIC_ALIASES.items() for x in (F.lit(k), F.lit(v))])
    canon = F.element_at(alias_map, F.lower(bare))
    bare2 = F.coalesce(F.substring(canon, 9, 1 << 20), bare)
    full = F.concat(F.lit("metrics."), bare2)
    valid = F.coalesce(full.isin(CANONICAL_METRIC_KEYS) & (raw != ""), F.lit(False))
    return F.struct(bare2.alias("bare"), full.alias("full"), valid.alias("valid"))


def metric_direction(name: Column | str) -> Column:
    """B15: 'min' when the name holds loss/error/rmse/mae, else 'max'."""
    low = F.lower(F.coalesce(_c(name), F.lit("")))
    cond = None
    for m in MIN_DIRECTION_MARKERS:
        cond = low.contains(m) if cond is None else (cond | low.contains(m))
    return F.when(cond, "min").otherwise("max")


def split_names(text: Column | str) -> Column:
    """Split on commas, trim, drop blanks, keep first occurrences in order."""
    parts = F.transform(F.split(F.coalesce(_c(text), F.lit("")), ","), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def parse_version(v: Column | str) -> Column:
    """B17: '1.2.10' -> array(1, 2, 10); NULL when any part is not all digits."""
    t = F.trim(_c(v).cast("string"))
    return F.when(t.rlike(r"^[0-9]+(\.[0-9]+)*$"),
                  F.transform(F.split(t, r"\."), lambda p: p.cast("long")))


def idempotency_key(parts: Sequence[Column | str], git_sha: Column | str | None = None) -> Column:
    """First 7 hex of sha1 over the non-empty trimmed parts joined by '::'."""
    cols = [F.trim(_c(p).cast("string")) for p in parts]
    if git_sha is not None:
        cols.append(F.trim(_c(git_sha).cast("string")))
    arr = F.filter(F.array(*cols), lambda x: x.isNotNull() & (x != ""))
    return F.substring(F.sha1(F.array_join(arr, "::")), 1, 7)


def clamp_alert_cap(c: Column | str) -> Column:
    """Alert cap -> max(int, 0); NULL stays NULL; text that is no integer raises."""
    v = _c(c)
    i = v.try_cast("long")
    return F.when(v.isNull(), F.lit(None).cast("long")).when(
        i.isNull(), F.raise_error(F.concat(F.lit("Invalid max_alerts '"), v.cast("string"), F.lit("'. Must be an integer.")))
    ).otherwise(F.greatest(i, F.lit(0)))


def normalize_alert_rate(c: Column | str) -> Column:
    """Rate <= 0 -> NULL (none), rate > 1 -> error."""
    v = _c(c).cast("double")
    return (F.when(v.isNull() | (v <= 0), F.lit(None).cast("double"))
            .when(v > 1, F.raise_error(F.lit("alert_rate must be in (0, 1]")).cast("double"))
            .otherwise(v))


def negate(c: Column | str) -> Column:
    """B20."""
    return -_c(c)


def percent(c: Column | str) -> Column:
    """Share to percent rounded to 2 places."""
    return F.round(_c(c) * 100, 2)
