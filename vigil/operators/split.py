"""Splits, folds, sampling and batching.

Every pseudo-random choice is an order by ``md5(key:seed)`` inside the
stratum, so a split is exact in size, repartition-proof and reproducible by
any engine that has md5. Splits and samples compare each row's hash with its
class's cut, found by selection (``hash_cuts``), and shuffle nothing; folds and
batches need every row's rank, from the distributed ``global_rank``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.primitives import global_rank
from vigil.operators.select import hash_cuts


def class_counts(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).count().collect()
    return {r[label]: r["count"] for r in rows}


def allocate_test(counts: dict, test: float, stratify: bool = True) -> dict:
    """Per-class test sizes: n_test = ceil(test * n); the train part is shared
    by floor plus largest remainder (ties to the smaller label)."""
    n = sum(counts.values())
    if n == 0:
        raise ValueError("Input DataFrame is empty.")
    if not 0 <= test < 1:
        raise ValueError("Test size must be between 0 and 1.")
    n_test = math.ceil(test * n)
    n_train = n - n_test
    if not stratify:
        return {"__all__": n_test}
    if test > 0:
        if min(counts.values()) < 2:
            raise ValueError("The least populated class in y has only 1 member, which is too few.")
        if n_test < len(counts) or n_train < len(counts):
            raise ValueError("The test and train sizes must each be at least the number of classes.")
    labels = sorted(counts, key=lambda v: (v is None, v))
    floors = {c: (n_train * counts[c]) // n for c in labels}
    rems = {c: (n_train * counts[c]) % n for c in labels}
    left = n_train - sum(floors.values())
    order = sorted(labels, key=lambda c: (-rems[c], labels.index(c)))
    train = dict(floors)
    for c in order[:left]:
        train[c] += 1
    return {c: counts[c] - train[c] for c in labels}


def _hash(key: str, *salt) -> F.Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), *[F.lit(str(s)) for s in salt]))


def _by_class(values: dict, label: str | None, kind) -> F.Column:
    """The value of a row's class as a column; rows without a label are a class of their own."""
    if label is None:
        return F.lit(values["__all__"])
    listed = [x for k, v in values.items() if k is not None for x in (F.lit(k), F.lit(v))]
    rest = F.lit(values.get(None, kind()))
    return F.coalesce(F.element_at(F.create_map(*listed), F.col(label)), rest) if listed else rest


def _mark_first(df: DataFrame, hashed: str, key: str, label: str | None, wanted, flag: str) -> tuple[DataFrame, dict, dict]:
    """Mark the first rows of each class by hash: a comparison with the class's cut, so no row is shuffled.

    If a cut would part equal hashes (rows that share a key), rows are ranked instead.
    Returns the marked rows, the class counts and the sizes.
    """
    sizes: dict = {}

    def choose(counts: dict) -> dict:
        sizes.update(wanted(counts))
        return sizes

    counts, cuts = hash_cuts(df, hashed, label, choose)
    if cuts is not None:
        return df.withColumn(flag, F.col(hashed) <= _by_class(cuts, label, str)), counts, sizes
    ranked = global_rank(df, hashed, group=label, rank_col="_srk", group_counts=counts if label else None)
    return ranked.withColumn(flag, F.col("_srk") <= _by_class(sizes, label, int)).drop("_srk"), counts, sizes


def mark_split(df: DataFrame, key: str, label: str = "Class", test: float = 0.1, seed: int = 42,
               stratify: bool = True, salt: Sequence = (), flag: str = "is_test") -> tuple[DataFrame, dict]:
    """D1 core: add boolean ``flag`` marking the exact test members.

    Returns the marked frame and the per-class test sizes."""
    if stratify and label not in df.columns:
        raise ValueError(f"There is no label column '{label}' to split by.")
    h = df.withColumn("_sh", _hash(key, seed, *salt))
    marked, _, sizes = _mark_first(h, "_sh", key, label if stratify else None, lambda c: allocate_test(c, test, stratify), flag)
    return marked.drop("_sh"), sizes


def split_data(df: DataFrame, key: str, label: str = "Class", test: float = 0.1, seed: int = 42,
               stratify: bool = True) -> tuple[DataFrame, DataFrame]:
    """(train, test); ``test=0`` gives an empty test frame with the same columns."""
    if test == 0:
        if df.isEmpty():
            raise ValueError("Input DataFrame is empty.")
        return df, df.limit(0)
    marked, _ = mark_split(df, key, label, test, seed, stratify)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where(F.col("is_test")).drop("is_test")


def three_way_split(df: DataFrame, key: str, label: str = "Class", test_size: float = 0.2,
                    val_size: float = 0.2, seed: int = 42, val_is_total: bool = False) -> DataFrame:
    """D3: adds ``split`` in {train, val, test}. Test is drawn first; the
    validation share then applies to the rest (rescaled if ``val_is_total``)."""
    m1, _ = mark_split(df, key, label, test_size, seed, flag="_is_test")
    v = val_size / (1 - test_size) if val_is_total else val_size
    m2, _ = mark_split(m1.where(~F.col("_is_test")), key, label, v, seed, salt=("val",), flag="_is_val")
    tests = m1.where(F.col("_is_test")).drop("_is_test").withColumn("split", F.lit("test"))
    others = m2.drop("_is_test").withColumn("split", F.when(F.col("_is_val"), "val").otherwise("train")).drop("_is_val")
    return others.unionByName(tests)


def stratified_kfold(df: DataFrame, key: str, label: str = "Class", k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """Fold id in 0..k-1 = (rank in stratum by md5 order - 1) mod k."""
    if k < 2:
        raise ValueError("k must be >= 2")
    h = df.withColumn("_fh", _hash(key, seed, "fold"))
    ranked = global_rank(h, "_fh", group=label, rank_col="_frk")
    return ranked.withColumn(fold_col, ((F.col("_frk") - 1) % k).cast("int")).drop("_fh", "_frk")


def undersample(df: DataFrame, key: str, label: str = "Class", seed: int = 42) -> DataFrame:
    """All positives plus as many negatives, chosen by md5 order."""
    h = df.withColumn("_uh", _hash(key, seed, "under"))
    marked, _, _ = _mark_first(h, "_uh", key, label, lambda c: {k: c.get(1, 0) if k == 0 else n if k == 1 else 0 for k, n in c.items()}, "_kept")
    return marked.where("_kept").drop("_uh", "_kept")


def batches(df: DataFrame, key_hex: str, batch_size: int = 200, batch_col: str = "batch_id",
            keep_rank: bool = False) -> DataFrame:
    """Contiguous batches of ``batch_size`` rows in key order."""
    size = max(int(batch_size), 1)
    ranked = global_rank(df, key_hex, rank_col="_brk")
    out = ranked.withColumn(batch_col, F.floor((F.col("_brk") - 1) / size).cast("long"))
    return out.withColumnRenamed("_brk", "row_rank") if keep_rank else out.drop("_brk")


def permute_within(df: DataFrame, key: str, group: str, column: str, repeat: int, seed: int = 42) -> DataFrame:
    """Shuffle ``column`` within ``group``: row i of the md5 order of the
    keys takes the value of row i of another md5 order (salted by repeat)."""
    a = global_rank(df.withColumn("_pa", _hash(key, seed, "perm-a")), "_pa", group=group, rank_col="_ra")
    b = global_rank(df.select(group, column, _hash(key, seed, "perm-b", repeat).alias("_pb")),
                    "_pb", group=group, rank_col="_ra").select(F.col(group).alias("_pg"), F.col("_ra").alias("_rb"), F.col(column).alias("_pv"))
    # rows without a group are a group
    pairs = a.join(b, a[group].eqNullSafe(F.col("_pg")) & (F.col("_ra") == F.col("_rb")))
    return pairs.drop(column, "_pa", "_ra", "_pg", "_rb").withColumnRenamed("_pv", column)
