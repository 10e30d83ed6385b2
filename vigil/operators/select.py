"""Order statistics by selection: rows near the wanted ranks are found by counting, no table is ordered.

P5 ``exact_quantiles``  numpy-style linear quantiles of many groups
P6 ``hash_cuts``        the k-th smallest hash of each class

Both work on counts that are bounded by construction and read on the driver:
pivots cut each group's values into stretches, one grouped count tells which
stretch holds a wanted rank, and only such stretches are cut again, until they
are small enough to order. Every count is a partial aggregate, so a level
shuffles at most (pivots x groups) rows for each task, whatever the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.primitives import _cols, _null_safe

#: A stretch of at most so many rows is ordered (in one task); longer ones are cut again.
FINISH_ROWS = 100_000
#: Accuracy of the pivots; it steers how many rows are left after a level, never the result.
SKETCH = 2000
#: Pivots that cut a stretch again.
PIVOTS = 32
#: A prefix that at most so many hashes share is read whole.
HASHES = 2000
LEVELS: list = []  # (number of open stretches, their largest size) after each level, for tests


def _pivot_table(like: DataFrame, keys: list[str], rows: list[tuple], width: int) -> DataFrame:
    """Keys and columns _p0, _p1, ... (padded with NaN, which no value reaches)."""
    fields = [T.StructField(k, like.schema[k].dataType, True) for k in keys]
    fields += [T.StructField(f"_p{i}", T.DoubleType()) for i in range(width)]
    padded = [(*key, *pivots, *[math.nan] * (width - len(pivots))) for key, pivots in rows]
    return like.sparkSession.createDataFrame(padded, T.StructType(fields))


def _cut(work: DataFrame, keys: list[str], pivots: dict[tuple, list[float]], name: str) -> DataFrame:
    """The rows of the listed stretches with their place among the pivots: 2i + 1 if equal to pivot i, 2i if between i - 1 and i."""
    width = max(map(len, pivots.values()))
    table = _pivot_table(work, keys, list(pivots.items()), width)  # a row for each open stretch
    v = F.col("_v")
    place = sum([(v > F.col(f"_p{i}")).cast("int") + (v >= F.col(f"_p{i}")).cast("int") for i in range(width)], F.lit(0))
    return _null_safe(work, table, keys, "inner").withColumn(name, place).drop(*[f"_p{i}" for i in range(width)])


def select_ranks(rows: DataFrame, value: str, group: Sequence[str], wanted: Callable[[int], Sequence[int]], near: Sequence[float] = ()) -> dict:
    """{(group values): (n, {rank: value})}: exact order statistics, ranks from 0.

    ``wanted`` gives a group's ranks from its row count; ``near`` are the
    probabilities around which the first pivots are put. NULL and NaN are left
    out; a NULL group is a group. Groups and ranks must be few: their counts
    are read on the driver.
    """
    keys = list(group)
    v = F.col(value).cast("double")
    work = rows.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    margin = 2 / SKETCH
    probs = sorted({min(max(p + s, 0.0), 1.0) for p in near for s in (-margin, margin)}) or [k / PIVOTS for k in range(1, PIVOTS)]
    first = work.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", probs, SKETCH).alias("_q")).collect()
    out = {tuple(r[k] for k in keys): (r["_n"], {}) for r in first}
    # an open stretch: its key (group and places so far) with its size and the ranks wanted in it, as (rank in the group, rank in the stretch)
    sizes = {g: n for g, (n, _) in out.items()}
    ranks = {g: [(r, r) for r in sorted(set(wanted(n)))] for g, (n, _) in out.items()}
    pivots = {tuple(r[k] for k in keys): sorted(set(r["_q"] or [])) for r in first}
    n_group = len(keys)
    LEVELS.clear()
    while any(sizes[s] > FINISH_ROWS and ranks[s] for s in sizes):
        level = f"_l{len(keys) - n_group}"
        if level != "_l0":
            grid = [k / PIVOTS for k in range(1, PIVOTS)]
            inside = _null_safe(work, _pivot_table(work, keys, [(s, []) for s in sizes], 0), keys, "left_semi")
            got = inside.groupBy(*keys).agg(F.percentile_approx("_v", grid, SKETCH).alias("_q")).collect()
            pivots = {tuple(r[k] for k in keys): sorted(set(r["_q"])) for r in got}
        work = _cut(work, keys, {s: pivots[s] for s in sizes if ranks[s]}, level)
        keys = [*keys, level]
        counts: dict[tuple, dict[int, int]] = {}
        for r in work.groupBy(*keys).count().collect():
            counts.setdefault(tuple(r[k] for k in keys[:-1]), {})[r[level]] = r["count"]
        new_sizes, new_ranks = {}, {}
        for s, by_place in counts.items():
            before, left = 0, list(ranks[s])
            for place in sorted(by_place):
                n = by_place[place]
                here = [(r, k - before) for r, k in left if k < before + n]
                left = [(r, k) for r, k in left if k >= before + n]
                before += n
                if here and place % 2:
                    out[s[:n_group]][1].update((r, pivots[s][place // 2]) for r, _ in here)
                elif here:
                    new_sizes[(*s, place)], new_ranks[(*s, place)] = n, here
        sizes, ranks = new_sizes, new_ranks
        LEVELS.append((len(sizes), max(sizes.values(), default=0)))
    found = [(*s, r, k) for s in sizes for r, k in ranks[s]]
    if found:
        fields = [T.StructField(k, work.schema[k].dataType, True) for k in keys] + [T.StructField("_rank", T.LongType()), T.StructField("_at", T.LongType())]
        table = rows.sparkSession.createDataFrame(found, T.StructType(fields))
        open_rows = _null_safe(work, table.select(*keys).distinct(), keys, "left_semi") if keys else work
        tied = open_rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
        order = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most FINISH_ROWS rows
        ends = tied.withColumn("_end", F.sum("_c").over(order))
        hits = _null_safe(ends, table, keys, "inner").where((F.col("_at") < F.col("_end")) & (F.col("_at") >= F.col("_end") - F.col("_c")))
        for r in hits.select(*keys[:n_group], "_rank", "_v").collect():
            out[tuple(r[k] for k in keys[:n_group])][1][r["_rank"]] = r["_v"]
    return out


def exact_quantiles(long: DataFrame, probs: Sequence[float], group: str | Sequence[str] = "feature",
                    value: str = "value", out_col: str = "q", prob_col: str = "prob") -> DataFrame:
    """P5: numpy ``linear`` quantiles per group: (group..., prob, q), one row for each group with values and probability."""
    keys, probs = _cols(group), [float(p) for p in probs]

    def ends(n: int, p: float) -> tuple[int, int]:
        return math.floor((n - 1) * p), math.ceil((n - 1) * p)

    picked = select_ranks(long, value, keys, lambda n: [k for p in probs for k in ends(n, p)] if n else [], probs)
    rows = []
    for g, (n, at) in picked.items():
        for p in probs if n else ():
            lo, hi = ends(n, p)
            rows.append((*g, p, at[lo] + (at[hi] - at[lo]) * ((n - 1) * p - lo)))
    fields = [T.StructField(k, long.schema[k].dataType, True) for k in keys]
    return long.sparkSession.createDataFrame(rows, T.StructType([*fields, T.StructField(prob_col, T.DoubleType()), T.StructField(out_col, T.DoubleType())]))


def edge_bin(value: Column, edges: Column, width: int, closed: bool = True) -> Column:
    """How many of at most ``width`` sorted edges lie at or below the value (below it, if not ``closed``); plain comparisons, no lambda."""
    one = [F.coalesce((value >= F.get(edges, F.lit(k))) if closed else (value > F.get(edges, F.lit(k))), F.lit(False)).cast("int") for k in range(width)]
    return sum(one, F.lit(0))


def hash_cuts(df: DataFrame, hashed: str, label: str | None, wanted: Callable[[dict], dict]) -> tuple[dict, dict | None]:
    """For each class the hash up to which (itself included) just so many rows lie as ``wanted`` says, given the class counts.

    ``hashed`` is a column of hex digests. Prefixes are counted three digits at
    a time, each time only below the prefix that holds the wanted rank, so a
    level reads at most 4,096 counts for each class. A cut is "" for no row and
    "~" for all. The second result is None if a cut would part equal hashes.
    """
    name = "_class"
    work = df.select((F.col(label) if label else F.lit("__all__")).alias(name), F.col(hashed).alias("_h"))
    counts: dict = {}
    by_prefix: dict = {}
    for r in work.groupBy(name, F.substring("_h", 1, 3).alias("_p")).count().collect():
        counts[r[name]] = counts.get(r[name], 0) + r["count"]
        by_prefix.setdefault(r[name], {})[r["_p"]] = r["count"]
    cuts, still = {}, {}
    for c, k in wanted(counts).items():
        if k <= 0 or k >= counts.get(c, 0):
            cuts[c] = "" if k <= 0 else "~"
        else:
            still[c] = k

    def below(prefixes: dict) -> DataFrame:
        tests = [F.col(name).eqNullSafe(F.lit(c)) & F.col("_h").startswith(p) for c, p in prefixes.items()]
        cond = tests[0]
        for t in tests[1:]:
            cond = cond | t
        return work.where(cond)

    digits, small = 3, {}
    while still:
        deeper = {}
        for c, k in still.items():
            before = 0
            for p in sorted(by_prefix[c]):
                if before + by_prefix[c][p] >= k:
                    break
                before += by_prefix[c][p]
            still[c] = k - before
            if by_prefix[c][p] <= HASHES or digits >= 32:
                small[c] = (p, k - before, by_prefix[c][p])
            else:
                deeper[c] = p
        still = {c: still[c] for c in deeper}
        if still:
            digits += 3
            by_prefix = {}
            for r in below(deeper).groupBy(name, F.substring("_h", 1, digits).alias("_p")).count().collect():
                by_prefix.setdefault(r[name], {})[r["_p"]] = r["count"]
    whole = {c: x for c, x in small.items() if x[2] > HASHES}  # one hash that more rows share than are read
    if any(k < n for _, k, n in whole.values()):
        return counts, None
    cuts.update((c, p) for c, (p, _, _) in whole.items())
    few = {c: x for c, x in small.items() if c not in whole}
    if few:
        listed: dict = {}
        for r in below({c: p for c, (p, _, _) in few.items()}).collect():  # at most HASHES rows for each class
            listed.setdefault(r[name], []).append(r["_h"])
        for c, (_, k, _) in few.items():
            h = sorted(listed[c])
            if k < len(h) and h[k] == h[k - 1]:
                return counts, None
            cuts[c] = h[k - 1]
    return counts, cuts
