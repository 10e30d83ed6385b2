"""Operator 2: reproducible shuffle and shards by a Feistel permutation of global row numbers.

1. Every row is reduced to (id, size, crc32 of the text). Its global row number
   is its place in the order of ``md5(id|size|crc)``: rows are counted by a
   fixed-size prefix of that digest, the running sum of these counts (at most
   ``BUCKETS`` numbers) gives each prefix its first number, and a window inside
   the prefix the rest. No window holds more than one prefix; rows that repeat
   in all three are counted first and numbered by explosion, so a repeated row
   cannot fill a task.
2. A Feistel network on Z_a x Z_b permutes the numbers 0 to a*b - 1, where
   a*b is at least the row count n; a result of n or more is walked on along its
   cycle until it falls below n. a and b are chosen so that a*b - n is at most
   ``MAX_WASTE``; a walk therefore ends after at most a*b - n more steps.
3. shard = p mod shards, slot = p div shards: both are computable from the row
   number alone, shard sizes differ by one row at most, and slots have no gaps.

The law is ``rows``. Only DataFrame functions are used. Groups (equal texts) are
not kept together, as the law of equal counts forbids that for a group that is
larger than a shard.

Defined cases: a null text has size 1 and checksum 0; a null id is ordered as
empty text; rows equal in id, size and checksum are interchangeable and get
numbers of their own; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import cut, only, read_table

BUCKETS = 1 << 12
ROUNDS = 6
MAX_WASTE = 16
#: The prime 2**31 - 1: products of two residues fit a long.
PRIME = 2147483647


def domain(n: int) -> tuple[int, int]:
    """(a, b), both near the square root of n, with n <= a*b <= n + MAX_WASTE."""
    a = max(1, math.isqrt(n))
    while (-n) % a > MAX_WASTE:  # a <= MAX_WASTE + 1 always ends it
        a -= 1
    return a, max(1, -(-n // a))


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three residues for each round, by a linear congruential rule from the seed."""
    x, keys = seed % PRIME, []
    for _ in range(ROUNDS):
        row = []
        for _ in range(3):
            x = (x * 48271 + 11) % PRIME
            row.append(x or 1)
        keys.append(tuple(row))
    return keys


def _mixed(x, k0, k1, k2):
    """A non-linear function of residues modulo PRIME; works on columns and on Python integers."""
    y = (x + k0) % PRIME * k1 % PRIME
    return (y * y % PRIME + y * k2 % PRIME) % PRIME


def permute_once(p: int, a: int, b: int, keys: list[tuple[int, int, int]]) -> int:
    """One application of the network to p = left * b + right, left in Z_a and right in Z_b."""
    x, y, size_x, size_y = p // b, p % b, a, b
    for key in keys:
        x, y, size_x, size_y = y, (x + _mixed(y, *key)) % size_x, size_y, size_x
    return x * b + y


def permuted(number: Column, n: int, seed: int) -> Column:
    """The place of a row number in the shuffle of 0 to n - 1, with cycle walking.

    Rounds and steps of a walk are folds over small arrays, so that the
    expression stays as small as one round.
    """
    a, b = domain(n)
    rounds = F.array(*[F.struct(*[F.lit(v).cast("long").alias(f"k{i}") for i, v in enumerate(key)]) for key in round_keys(seed)])

    def state(x, y, size_x, size_y):
        return F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), size_x.cast("long").alias("a"), size_y.cast("long").alias("b"))

    def one_round(s, k):
        return state(s["y"], (s["x"] + _mixed(s["y"], k["k0"], k["k1"], k["k2"])) % s["a"], s["b"], s["a"])

    def network(p):
        start = state(F.floor((p - p % b) / b), p % b, F.lit(a), F.lit(b))
        return F.aggregate(rounds, start, one_round, lambda s: s["x"] * b + s["y"])

    steps = F.sequence(F.lit(0), F.lit(a * b - n))
    return F.aggregate(steps, number.cast("long"), lambda p, step: F.when((step > 0) & (p < n), p).otherwise(network(p)))


def row_numbers(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` (doc_id, size, text_crc32) with their global ``number`` from 0, and how many there are."""
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32").cast("binary"))
    same = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    keyed = cut(same.withColumn("order", key).withColumn("bucket", F.conv(F.substring("order", 1, 3), 16, 10).cast("int")))
    totals = keyed.groupBy("bucket").agg(F.sum("copies").alias("n")).collect()  # at most BUCKETS rows
    n, starts = 0, []
    for t in sorted(totals):
        starts.append((t.bucket, n))
        n += t.n
    if n == 0:
        return keyed.select("doc_id", "size", "text_crc32", F.lit(0).cast("long").alias("number")), 0
    start = rows.sparkSession.createDataFrame(starts, "bucket int, start long")
    inside = Window.partitionBy("bucket").orderBy("order", F.col("doc_id").cast("string")).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(F.broadcast(start), "bucket")  # at most BUCKETS rows
    first = F.col("start") + F.col("before")
    return placed.select("doc_id", "size", "text_crc32", F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("number")), n


def shards(docs: DataFrame, n_shards: int = 16, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, number, place, shard, slot."""
    raw = F.col("text").cast("binary")
    rows = only(docs, doc_id=id_col, text=text_col).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"))
    numbered, n = row_numbers(rows)
    place = permuted(F.col("number"), n, seed) if n else F.col("number")
    return numbered.withColumn("place", place).withColumns({
        "shard": (F.col("place") % n_shards).cast("int"),
        "slot": F.floor((F.col("place") - F.col("place") % n_shards) / n_shards).cast("long"),
    })


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all of ``documents`` in 16 shards of equal row counts."""
    return shards(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
