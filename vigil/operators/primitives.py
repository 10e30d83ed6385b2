"""Order primitives that never put a whole table into one task.

P1 ``global_rank``    exact row_number over a total order (optionally per group)
P2 ``running_sums``   cumulative sums over the distinct values of a column
P4 ``to_long``        features to (feature, value) rows, finite values only

Both P1 and P2 cut the order into buckets whose bounds are collected once
(a bounded list of numbers, so every later branch of the plan sees the same
literals), count rows per bucket in a small table, turn those counts into
offsets with a window over that small table, and finish with a window that is
partitioned by (group, bucket). Hot tied values are split further by bounds on
the key in its own order, so one value holding a third of the rows still spreads
over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import ensure_checkpoint_dir, shuffle_partitions

INF = float("inf")

# Number of approximate quantile bounds used to bucket an order column.
DEFAULT_BOUNDS = 256
# Accuracy passed to percentile_approx; bounds only steer balance, never results.
BOUND_ACCURACY = 10000


def _cols(names: str | Sequence[str] | None) -> list[str]:
    if names is None:
        return []
    if isinstance(names, str):
        return [names]
    return list(names)


def materialize(df: DataFrame) -> DataFrame:
    """Eager, reliable checkpoint into ``spark.checkpoint.dir``: for tables
    that feed both a bounds job and a final plan (computed once, lineage cut,
    recoverable after executor loss). Never ``localCheckpoint``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """The same rows dealt by key, one part for each core. Boosting passes over
    its table thousands of times, and a table has as many parts as its files
    gave it, however many cores wait. Hashing the key gives the same parts on every run."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1), key)


def finite(c: Column | str) -> Column:
    """Not null, not NaN, not infinite."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(INF))


def to_long(df: DataFrame, id_cols: Sequence[str], features: Sequence[str],
            feature_col: str = "feature", value_col: str = "value",
            keep_non_finite: bool = False) -> DataFrame:
    """Unpivot ``features`` (cast to double) into (ids..., feature, value)."""
    ids = list(id_cols)
    cast = df.select(*ids, *[F.col(f).cast("double").alias(f) for f in features])
    long = cast.unpivot(ids, list(features), feature_col, value_col)
    if not keep_non_finite:
        long = long.where(finite(value_col))
    return long


def _bounds_info(df: DataFrame, group: list[str], value: str, n_bounds: int) -> list[tuple]:
    """Collect, per group: (group values, sorted distinct bounds, multiplicity of
    each bound among the raw quantiles, row count, NULLs, NaNs). One aggregate
    job; the result is bounded by groups x n_bounds numbers."""
    if n_bounds - 1 > MOST_BOUNDS:
        raise ValueError(f"n_bounds must be at most {MOST_BOUNDS + 1}")
    probs = [i / n_bounds for i in range(1, n_bounds)]
    v = F.col(value)
    clean = F.when(v.isNotNull() & ~F.isnan(v), v)
    aggs = [F.percentile_approx(clean, probs, BOUND_ACCURACY).alias("_q"), F.count(F.lit(1)).alias("_n"),
            F.count_if(v.isNull()).alias("_nulls"), F.count_if(F.isnan(v)).alias("_nans")]
    rows = (df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)).collect()
    out = []
    for r in rows:
        raw = [x for x in (r["_q"] or []) if x is not None]
        bounds = sorted(set(raw))
        mult = [raw.count(x) for x in bounds]
        out.append((tuple(r[g] for g in group), bounds, mult, r["_n"], r["_nulls"], r["_nans"]))
    return out


def _bounds_df(spark: SparkSession, schema_src: DataFrame, group: list[str], info: list[tuple],
               extra: list[str] | None = None, name: str = "_bounds") -> DataFrame:
    fields = [T.StructField(g, schema_src.schema[g].dataType, True) for g in group]
    fields += [T.StructField(e, T.ArrayType(T.IntegerType()), True) for e in (extra or [])]
    fields.append(T.StructField(name, T.ArrayType(T.DoubleType()), True))
    return spark.createDataFrame([tuple(gv) + (b,) for gv, b, *_ in info], T.StructType(fields))


def _bounds_table(spark: SparkSession, df: DataFrame, group: list[str], value: str,
                  n_bounds: int, name: str = "_bounds") -> DataFrame:
    """Per-group approximate quantile bounds as a small driver-built table."""
    info = _bounds_info(df, group, value, n_bounds)
    return _bounds_df(spark, df, [g for g in group if g != "_b"], info, ["_b"] if "_b" in group else None, name)


MOST_BOUNDS = 1023  # the longest list of bounds that ``_bounds_before`` looks through


def _value_bucket(value: str, bounds: str, descending: bool) -> Column:
    """Monotone bucket 2g+e of ``value`` over sorted distinct ``bounds``: g counts
    the bounds before the value in the order and e = 1 when the value equals a
    bound, so a hot value that spans many quantiles gets a bucket of its own.
    NULL sorts first ascending and last descending, NaN sorts largest (Spark's order)."""
    v = F.col(value)
    b = F.col(bounds)
    if descending:
        upto = _bounds_before(b, lambda x: x <= v)
        e = F.coalesce(F.get(b, upto - 1) == v, F.lit(False)).cast("int")
        return F.when(v.isNull(), 2 * F.size(b) + 4).otherwise(2 * (F.size(b) - upto) + e)
    g = _bounds_before(b, lambda x: x < v)
    e = F.coalesce(F.get(b, g) == v, F.lit(False)).cast("int")
    return F.when(v.isNull(), F.lit(-1)).otherwise(2 * g + e)


def _bounds_before(bounds: Column, holds) -> Column:
    """How many of the sorted bounds ``holds`` is true for (a leading stretch of
    them), by halving: ten looks at each row's bounds instead of one at every bound."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(MOST_BOUNDS.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(holds(F.get(bounds, at + step - 1)), at + step).otherwise(at))


def _in_buckets(df: DataFrame, value: str, bounds: list[float], descending: bool, out: str) -> DataFrame:
    """``_value_bucket`` for one list of bounds that the driver holds: a binary search of each row (``Bucketizer``)."""
    v, n = F.col(value), len(bounds)
    missing = F.lit(2 * n + 4 if descending else -1)
    if not n or not all(map(math.isfinite, bounds)):  # Bucketizer wants finite bounds
        listed = df.withColumn("_bounds", F.array(*[F.lit(float(b)) for b in bounds]).cast("array<double>"))
        return listed.withColumn(out, _value_bucket(value, "_bounds", descending)).drop("_bounds")
    cuts = [float(b) for b in bounds]
    found = Bucketizer(splits=[-INF, *cuts, INF], inputCol=value, outputCol="_upto", handleInvalid="keep").transform(df)
    upto = F.col("_upto").cast("int")  # bounds before or at the value; NaN lies behind all
    e = F.coalesce(F.get(F.array(*map(F.lit, cuts)), upto - 1) == v, F.lit(False)).cast("int")
    place = 2 * (F.lit(n) - upto) + e if descending else 2 * upto - e
    return found.withColumn(out, F.when(v.isNull(), missing).otherwise(place)).drop("_upto")


MAX_LEVELS = 4
LEVEL_LOG: list = []  # (level, refined buckets, single-value buckets), for tests
MIN_BUCKET_ROWS = 20000
ROOMY_BUCKET_ROWS = 1_000_000  # one task sorts so many rows in memory

LEAD_BYTES = 4  # leading bytes of a text key by which its rows are counted
MOST_LEADS = 1 << 18  # most leading texts whose offsets are broadcast


def _target(spark: SparkSession, total: int) -> int:
    """Rows that a bucket may hold: a few buckets for each core, and more of them once these would be too large to sort in memory."""
    cores = max(spark.sparkContext.defaultParallelism, 1)
    return max(MIN_BUCKET_ROWS, math.ceil(total / (4 * shuffle_partitions(spark))), min(math.ceil(total / (4 * cores)), ROOMY_BUCKET_ROWS))


FEW_LISTS = 4  # so many lists of bounds are looked through by ``_in_buckets``, more are joined
KEY_BOUNDS = 512  # at most so many bounds cut one single-value bucket by its key


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Join a small table by columns in which NULL equals NULL (a NULL group is a group)."""
    small = right.select(*[F.col(c).alias(f"_j_{c}") if c in cols else F.col(c) for c in right.columns])
    if not cols:
        return left if how == "left_semi" else left.join(F.broadcast(small), how=how)
    cond = None
    for c in cols:
        same = left[c].eqNullSafe(small[f"_j_{c}"])
        cond = same if cond is None else cond & same
    out = left.join(F.broadcast(small), cond, how)
    return out if how == "left_semi" else out.drop(*[f"_j_{c}" for c in cols])


def _key_number(key: str, kind: T.DataType, skip: Column) -> Column:
    """A double that never falls as the key rises in Spark's own order: the
    number itself, or of other keys six bytes of their text behind the ``skip``
    leading bytes that all keys of the bucket share."""
    if isinstance(kind, T.NumericType):
        return F.col(key).cast("double")
    if not isinstance(kind, (T.StringType, T.BinaryType)):
        return F.unix_micros(F.col(key).cast("timestamp")).cast("double") if isinstance(kind, (T.DateType, T.TimestampType)) \
            else F.lit(0.0)
    part = F.rpad(F.expr(f"substring(hex(`{key}`), 2 * _skip + 1, 12)"), 12, "0")
    return F.when(F.col(key).isNotNull(), F.conv(part, 16, 10).cast("double"))


def _common_bytes(lo, hi) -> int:
    if lo is None or hi is None:
        return 0
    x = lo.encode() if isinstance(lo, str) else bytes(lo)
    y = hi.encode() if isinstance(hi, str) else bytes(hi)
    n = 0
    while n < min(len(x), len(y)) and x[n] == y[n]:
        n += 1
    return n


def _split_by_key(work: DataFrame, spark: SparkSession, group: list[str], key: str, picked: list[tuple],
                  rows: float, target: int, ofield: list) -> DataFrame:
    """Append a level to the listed single-value buckets: bounds on the key's
    own order, so that ranks stay the same at every size and for every key type."""
    kind = work.schema[key].dataType
    bschema = T.StructField("_b", T.ArrayType(T.IntegerType()), True)
    sel = spark.createDataFrame(picked, T.StructType([*ofield, bschema]))
    sub = _null_safe(work, sel, [*group, "_b"], "left_semi")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        ends = sub.groupBy(*group, "_b").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        skips = [tuple(r[g] for g in group) + (list(r["_b"]), _common_bytes(r["lo"], r["hi"])) for r in ends]
    else:
        skips = [(*p, 0) for p in picked]
    stable = spark.createDataFrame(skips, T.StructType([*ofield, bschema, T.StructField("_skip", T.IntegerType())]))
    n_bounds = int(min(KEY_BOUNDS, max(4, math.ceil(2 * rows / target))))
    numbered = _null_safe(sub, stable, [*group, "_b"]).withColumn("_kn", _key_number(key, kind, F.col("_skip")))
    info = _bounds_info(numbered.select(*group, "_b", "_kn"), [*group, "_b"], "_kn", n_bounds)
    if len(info) <= FEW_LISTS:
        skip = {(*p[:-2], tuple(p[-2])): p[-1] for p in skips}
        out, path = work, F.col("_b")
        for i, (gv, b, *_) in enumerate(info):
            here = F.col("_b") == F.array(*map(F.lit, gv[-1]))
            for f, x in zip(ofield, gv):
                here = here & F.col(f.name).eqNullSafe(F.lit(x).cast(f.dataType))
            out = out.withColumn("_skip", F.lit(skip[(*gv[:-1], tuple(gv[-1]))])).withColumn(f"_kn{i}", F.when(here, _key_number(key, kind, F.col("_skip"))))
            out = _in_buckets(out.drop("_skip"), f"_kn{i}", b, False, f"_kb{i}")
            path = F.when(here, F.concat("_b", F.array(F.col(f"_kb{i}")))).otherwise(path)
        return out.withColumn("_b", path).drop(*[f"_k{c}{i}" for i in range(len(info)) for c in "nb"])
    bt = _bounds_df(spark, work, group, [(gv[:-1] + (list(gv[-1]),), b) for gv, b, *_ in info], ["_b"])
    small = _null_safe(stable, bt, [*group, "_b"])
    out = _null_safe(work, small, [*group, "_b"]).withColumn("_kn", _key_number(key, kind, F.col("_skip")))
    return (out.withColumn("_b", F.when(F.col("_bounds").isNull(), F.col("_b")).otherwise(
                F.concat("_b", F.array(_value_bucket("_kn", "_bounds", False)))))
            .drop("_skip", "_kn", "_bounds"))


def order_buckets(df: DataFrame, group: list[str], order: str | None, descending: bool,
                  key_hex: str | None = None, n_bounds: int | None = None,
                  group_counts: dict | None = None) -> DataFrame:
    """Add ``_b`` (array<int>), a bucket path that is monotone in the order
    (group..., order, key_hex): equal paths hold contiguous runs of the order
    and paths compare lexicographically.

    Level 0 cuts the order at approximate quantiles (one bounded collect that
    also returns the row count). The quantile guarantee bounds every bucket's
    size, so buckets are only counted when that bound exceeds the target;
    then over-full buckets are refined level by level with finer bounds, and
    buckets holding a single value are cut by bounds on ``key_hex`` itself.
    """
    spark = df.sparkSession
    n_bounds = n_bounds or DEFAULT_BOUNDS
    ofield = [T.StructField(g, df.schema[g].dataType, True) for g in group]
    bschema = T.StructField("_b", T.ArrayType(T.IntegerType()), True)

    if order is None:
        if not group and key_hex is not None and isinstance(df.schema[key_hex].dataType, T.NumericType):
            numbered = df.withColumn("_kn", F.col(key_hex).cast("double"))
            (_, bounds, _, total, *_), = _bounds_info(numbered.select("_kn"), [], "_kn", KEY_BOUNDS)
            if total <= _target(spark, total):
                return df.withColumn("_b", F.array(F.lit(0)))
            LEVEL_LOG.append(("key", 1))
            return _in_buckets(numbered, "_kn", bounds, False, "_first").withColumn("_b", F.array("_first")).drop("_kn", "_first")
        if group_counts is None:
            rows = (df.groupBy(*group).count() if group else df.groupBy().count()).collect()
            group_counts = {tuple(r[g] for g in group): r["count"] for r in rows}
        else:
            group_counts = {(k if isinstance(k, tuple) else (k,)) if group else (): v
                            for k, v in group_counts.items()}
        total = sum(group_counts.values())
        target = _target(spark, total)
        work = df.withColumn("_b", F.array(F.lit(0)))
        lens = [tuple(gv) + ([0],) for gv, n in group_counts.items() if n > target]
        if lens and key_hex is not None:
            LEVEL_LOG.append(("key", len(lens)))
            work = _split_by_key(work, spark, group, key_hex, lens, max(group_counts.values()), target, ofield)
        return work

    info = _bounds_info(df.select(*group, order), group, order, n_bounds)
    total = sum(i[3] for i in info)
    target = _target(spark, total)
    if group:
        bt = _bounds_df(spark, df, group, info)
        work = _null_safe(df, bt, group)
        work = work.withColumn("_b", F.array(_value_bucket(order, "_bounds", descending))).drop("_bounds")
    else:  # one bounds list: no join
        work = _in_buckets(df, order, info[0][1], descending, "_first").withColumn("_b", F.array("_first")).drop("_first")

    # Size bounds from the quantile guarantee (rank error n / accuracy).
    need_count = False
    lens, largest = [], 0.0
    for gv, bounds, mult, n, nulls, nans in info:
        step, err = n / n_bounds, 2 * n / BOUND_ACCURACY
        if step + 2 * err > target or nans > target:
            need_count = True
        if nulls > target and key_hex is not None:
            lens.append(tuple(gv) + ([2 * len(bounds) + 4 if descending else -1],))
            largest = max(largest, nulls)
        for i, m in enumerate(mult):
            est = (m + 1) * step + 2 * err
            if est > target and key_hex is not None:
                code = 2 * (len(bounds) - 1 - i) + 1 if descending else 2 * i + 1
                lens.append(tuple(gv) + ([code],))
                largest = max(largest, est)
    if not need_count:
        if lens:
            LEVEL_LOG.append(("key", len(lens)))
            work = _split_by_key(work, spark, group, key_hex, lens, largest, target, ofield)
        return work

    for level in range(MAX_LEVELS + 1):
        counts = work.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_cnt"), F.min(order).alias("_lo"),
                                                F.max(order).alias("_hi")).collect()
        big = [r for r in counts if r["_cnt"] > target]
        single = [r for r in big if r["_lo"] == r["_hi"]]
        multi = [r for r in big if r["_lo"] != r["_hi"]]
        if multi and level < MAX_LEVELS:
            LEVEL_LOG.append((level, len(multi), len(single)))
            sel = spark.createDataFrame([tuple(r[g] for g in group) + (list(r["_b"]),) for r in multi],
                                        T.StructType(ofield + [bschema]))
            sub = _null_safe(work, sel, [*group, "_b"], "left_semi")
            binfo = _bounds_info(sub.select(*group, "_b", order), [*group, "_b"], order, n_bounds)
            bt2 = _bounds_df(spark, df, group, [(gv[:-1] + (list(gv[-1]),), b) for gv, b, *_ in binfo],
                             ["_b"])
            work = (_null_safe(work, bt2, [*group, "_b"])
                    .withColumn("_b", F.when(F.col("_bounds").isNull(), F.col("_b")).otherwise(
                        F.concat("_b", F.array(_value_bucket(order, "_bounds", descending)))))
                    .drop("_bounds"))
            if not single:
                continue
        if single and key_hex is not None:
            LEVEL_LOG.append(("key", len(single)))
            lens = [tuple(r[g] for g in group) + (list(r["_b"]),) for r in single]
            work = _split_by_key(work, spark, group, key_hex, lens, max(r["_cnt"] for r in single), target, ofield)
        break
    return work


def _by_leads(df: DataFrame, group: list[str], key: str) -> tuple[DataFrame, DataFrame] | None:
    """Buckets ``_b`` by the leading bytes of a text key and each bucket's offset ``_off``.

    One count gives both, so keys are made and read once before the rows
    themselves. None if the leading bytes are too many, or part the rows so
    badly that a bucket would be too large: then bounds must be found.
    """
    if not isinstance(df.schema[key].dataType, (T.StringType, T.BinaryType)):
        return None
    # bytes, as Spark orders texts by them
    lead = F.col(key).cast("binary")
    counts = materialize(df.groupBy(*group, F.substring(lead, 1, LEAD_BYTES).alias("_b")).agg(F.count(F.lit(1)).alias("_bn")))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    for size in range(LEAD_BYTES, 0, -1):  # fewer bytes where many groups have as many leads each
        some = counts.groupBy(*group, F.substring("_b", 1, size).alias("_b")).agg(F.sum("_bn").alias("_bn"))
        found = some.agg(F.count(F.lit(1)).alias("leads"), F.max("_bn").alias("most"), F.sum("_bn").alias("total")).first()
        if (found["most"] or 0) > _target(df.sparkSession, found["total"] or 0):
            break
        if found["leads"] <= MOST_LEADS:
            return df.withColumn("_b", F.substring(lead, 1, size)), some.select(*group, "_b", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"))
    return None


def global_rank(df: DataFrame, key_hex: str, order: str | None = None, descending: bool = True,
                group: str | Sequence[str] | None = None, rank_col: str = "rank",
                n_bounds: int | None = None, group_counts: dict | None = None) -> DataFrame:
    """Exact ``row_number`` over (group..., order [desc], key_hex asc).

    ``key_hex`` names a unique key of any orderable type; it breaks ties in its
    own order, and bounds on it split hot buckets. NULL groups are a group.
    """
    group = _cols(group)
    bucket = [*group, "_b"]
    led = _by_leads(df, group, key_hex) if order is None else None
    if led:
        work, offsets = led
    else:
        work = order_buckets(df, group, order, descending, key_hex, n_bounds, group_counts)
        sizes = work.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_bn"))
        w_off = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.withColumn("_off", F.coalesce(F.sum("_bn").over(w_off), F.lit(0))).drop("_bn")

    o = []
    if order is not None:
        o.append(F.col(order).desc() if descending else F.col(order).asc())
    o.append(F.col(key_hex).asc())
    w = Window.partitionBy(*bucket).orderBy(*o)
    ranked = work.withColumn("_rn", F.row_number().over(w))
    # offsets has one row per non-empty bucket: about 4 x shuffle partitions rows, or at most MOST_LEADS.
    out = (_null_safe(ranked, offsets, bucket, "inner")
           .withColumn(rank_col, (F.col("_off") + F.col("_rn")).cast("long"))
           .drop("_b", "_rn", "_off"))
    return out


def running_sums(df: DataFrame, value: str, sums: Sequence[str], group: str | Sequence[str] | None = None,
                 descending: bool = False, n_bounds: int | None = None,
                 inclusive_suffix: str = "_cum") -> DataFrame:
    """For a table with one row per distinct (group, value) and count-like
    columns ``sums``, add ``<s>_cum`` = sum of ``s`` over rows with value before
    or equal in the order (ascending by default), per group.

    Values must already be distinct per group (use ``groupBy(group, value)``).
    """
    group = _cols(group)
    work = order_buckets(df, group, value, descending, None, n_bounds)
    bucket = [*group, "_b"]
    totals = work.groupBy(*bucket).agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    w_off = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*bucket, *[
        F.coalesce(F.sum(f"_t_{s}").over(w_off), F.lit(0)).alias(f"_o_{s}") for s in sums])

    ordc = F.col(value).desc() if descending else F.col(value).asc()
    w = Window.partitionBy(*bucket).orderBy(ordc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = work.select("*", *[F.sum(s).over(w).alias(f"_w_{s}") for s in sums])
    out = _null_safe(within, offsets, bucket, "inner")
    out = out.select(*[c for c in df.columns], *[(F.col(f"_o_{s}") + F.col(f"_w_{s}")).alias(f"{s}{inclusive_suffix}") for s in sums])
    return out
