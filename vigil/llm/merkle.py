"""Operator 13: a Merkle manifest of a dataset, one hash tree for each group and one over the groups.

1. Every row becomes a leaf: the SHA-256 of its fields, each as byte count, ``:``
   and value, or ``-`` if null. Rows are placed by a range shuffle on (group,
   key, leaf): the place inside a sorted partition plus the rows of earlier
   partitions (one small table of partitions and groups) is the number of the
   leaf in its group. No window runs over a group.
2. Level by level, the nodes are windowed by their parent, so a window holds at
   most ``FANOUT`` nodes. Lag and lead columns of the fixed offsets 1 to
   FANOUT - 1, masked by the node's slot and the length of its run, supply the
   siblings left and right of a node; the row of a first child hashes the run
   into the parent, a row of the next level. A group of one node is done: the
   node is its subroot. Subroots are the leaves of the last tree.
3. Downwards, every level joins its parents' paths (an array of the siblings left
   and right, level by level), so that a leaf carries all that it takes to
   recompute the root. A path grows with the logarithm of the rows.

Only narrow rows (digests as 32 bytes) are shuffled, after one scan of the texts.
Levels are checkpointed: a lost executor costs at most one level.

Defined cases: a null group is a group and comes first; a null key comes first;
of equal keys the smaller leaf comes first, rows that agree in both are
interchangeable, and each is a leaf of its own; a null field is told apart from
an empty one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import cut, read_table
from vigil.session import shuffle_partitions

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hex digest of the fields in order, each ``-`` if null, else byte count, ``:`` and value."""

    def shown(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[shown(c) for c in fields]).cast("binary"), 256)


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx``, their place (from 0) in their group by ``order``, and ``n``, the rows of the group."""
    spark = rows.sparkSession
    # rows that agree in the order are spread by their place in the input: any order of them will do
    spread = cut(rows.withColumn("_tie", F.monotonically_increasing_id()))
    placed = (spread.repartitionByRange(shuffle_partitions(spark), group, *order, "_tie").sortWithinPartitions(group, *order, "_tie")
              .drop("_tie").withColumn("_at", F.monotonically_increasing_id()))  # partition number * 2**33 + place
    placed = cut(placed.withColumn("_part", F.shiftright("_at", 33)))
    sizes = placed.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    mine = Window.partitionBy("_g")  # at most one row for each partition
    before = mine.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_g", "_p", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(mine).alias("n"))
    return (placed.join(sizes, (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")))
            .withColumn("idx", F.col("_at") + F.col("_shift")).drop("_g", "_p", "_at", "_part", "_shift"))


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``nodes`` (tree, idx, n, hash as bytes) with parent, and the digests left and right of each in its run, as bytes."""
    slot = F.col("idx") % fanout
    run = Window.partitionBy("tree", "parent").orderBy("idx")  # at most ``fanout`` rows
    length = F.least(F.lit(fanout), F.col("n") - F.col("parent") * fanout)
    rows = nodes.withColumn("parent", F.floor(F.col("idx") / fanout).cast("long"))
    masked = {f"_l{k}": F.when(slot >= k, F.lag("hash", k).over(run)) for k in range(fanout - 1, 0, -1)}
    masked |= {f"_r{k}": F.when(slot + k < length, F.lead("hash", k).over(run)) for k in range(1, fanout)}
    ends = {"left": [c for c in masked if c.startswith("_l")], "right": [c for c in masked if c.startswith("_r")]}
    return rows.withColumns(masked).select(*rows.columns, *[
        F.concat(F.lit(b""), *[F.coalesce(c, F.lit(b"")) for c in names]).alias(side) for side, names in ends.items()])


def _parents(siblings: DataFrame, fanout: int) -> DataFrame:
    """The next level: the row of each first child hashes its run."""
    return siblings.where(F.col("idx") % fanout == 0).select(
        "tree", F.col("parent").alias("idx"), F.ceil(F.col("n") / fanout).cast("long").alias("n"),
        F.unhex(F.sha2(_hex(F.concat("hash", "right")).cast("binary"), 256)).alias("hash"))


def climb(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The node tables (tree, idx, n, hash) of all levels, ``leaves`` first; a tree's last one is where its n is 1."""
    n = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves]
    while n > 1:
        levels.append(cut(_parents(with_siblings(levels[-1].where("n > 1").select("tree", "idx", "n", "hash"), fanout), fanout)))
        n = -(-n // fanout)
    return levels


def subroots(levels: list[DataFrame]) -> DataFrame:
    """(tree, hash) of every tree."""
    return reduce(DataFrame.unionByName, [level.where("n = 1").select("tree", "hash") for level in levels])


def descend(levels: list[DataFrame], heads: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The leaves with the columns of their tree's row of ``heads`` (tree, path and more), each path begun with the siblings from the leaf up to the subroot.

    Heads meet the one subroot of their tree; from there on every level joins on the parent, so a large tree is no hot key.
    """
    tops = heads.withColumnRenamed("tree", "_t")
    carried = [c for c in tops.columns if c not in ("_t", "path")]
    below = None
    for level in reversed(levels):
        done = level.where("n = 1").join(tops, F.col("tree") == F.col("_t")).drop("_t")
        if below is not None:
            up = below.select(F.col("tree").alias("_t"), F.col("idx").alias("_i"), F.col("path").alias("_up"), *carried)
            inner = with_siblings(level.where("n > 1"), fanout).join(up, (F.col("tree") == F.col("_t")) & (F.col("parent") == F.col("_i")))
            inner = inner.withColumn("path", F.concat(F.array(F.struct("left", "right")), "_up"))
            done = done.unionByName(inner.drop("_t", "_i", "_up", "parent", "left", "right"))
        below = done
    return below


EMPTY_PATH = "cast(array() as array<struct<left: binary, right: binary>>)"


def fold(path: Column, leaf: Column) -> Column:
    """The root (hex) that a leaf (hex) and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(_hex(s["left"]), acc, _hex(s["right"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    digests = F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"])))
    return F.sha2(F.concat_ws("", digests).cast("binary"), 256)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id", probe: Column | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """One row for each row of ``docs``: key, tree (the group), leaf, subroot, root (hex) and path (array of the digests left and right, as bytes).

    With ``probe``, a hex digest computed from the row in the same scan, the
    rows also have folded, the root that the probe gives in the leaf's place.
    """
    # the first letter keeps a null group apart from all others, and before them
    tree = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0"))
    leaf = leaf_hash([F.col(f"`{f}`") for f in fields])
    rows = docs.select(F.col(f"`{key}`").alias("key"), tree.alias("tree"), F.unhex(leaf).alias("hash"), *([F.unhex(probe).alias("probe")] if probe is not None else []))
    levels = climb(numbered(rows, "tree", ["key", "hash"]), fanout)
    upper = climb(numbered(subroots(levels).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash"), "tree", ["name"]), fanout)
    root = subroots(upper).select("tree", F.col("hash").alias("root"), F.expr(EMPTY_PATH).alias("path"))
    heads = cut(descend(upper, root, fanout).select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), "root", "path"))
    out = descend(levels, heads, fanout).select(
        "key", F.when(F.col("tree") != "0", F.expr("substring(tree, 2)")).alias("tree"), _hex(F.col("hash")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"), "path", *([_hex(F.col("probe")).alias("probe")] if probe is not None else []))
    return out.withColumn("folded", fold(F.col("path"), F.col("probe"))) if probe is not None else out


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the manifest of all documents, and every proof checked, with the texts of one third of the rows tampered with.

    A row without an id is not tampered with.
    """
    docs = read_table(spark, sf_dir, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    tampered = [F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text")) if f == "text" else F.col(f) for f in FIELDS]
    rows = manifest(docs, probe=leaf_hash(tampered))
    return rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


# crc32 of a short text by its definition: eight steps a byte with the reflected polynomial 0xEDB88320.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda c, x: list_reduce(list_prepend(xor(c, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda d, i: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END)), 4294967295)"""


def _sql_leaf(text: str) -> str:
    def shown(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"

    return "sha256(" + " || ".join(shown(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP13_SQL = f"""
WITH RECURSIVE raw AS (
  SELECT doc_id, lang, {_sql_leaf('text')} AS leaf, CASE WHEN {_CRC} % 3 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_sql_leaf('text')} END AS tampered
  FROM documents),
leaves AS (
  SELECT *, coalesce('1' || lang, '0') AS tree, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM raw WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
low AS (
  SELECT 0 AS lvl, tree, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lvl + 1, tree, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY lvl, tree, idx // 8, n),
tops AS (SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, '' AS tree, idx, n, h FROM tops
  UNION ALL
  SELECT lvl + 1, tree, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY lvl, tree, idx // 8, n),
nodes AS (
  SELECT 0 AS part, *, coalesce(string_agg(h, '') OVER b, '') AS l, coalesce(string_agg(h, '') OVER a, '') AS r FROM low
  WINDOW b AS (PARTITION BY lvl, tree, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         a AS (PARTITION BY lvl, tree, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
  UNION ALL
  SELECT 1 AS part, *, coalesce(string_agg(h, '') OVER b, '') AS l, coalesce(string_agg(h, '') OVER a, '') AS r FROM high
  WINDOW b AS (PARTITION BY lvl, tree, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         a AS (PARTITION BY lvl, tree, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
walk AS (
  SELECT doc_id, leaf, v.tree, v.idx AS own, 0 AS part, 0 AS lvl, v.tree AS at, v.idx, v.n, '' AS proof, tampered AS folded FROM leaves v
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.own,
         CASE WHEN w.n > 1 THEN w.part ELSE w.part + 1 END, CASE WHEN w.n > 1 THEN w.lvl + 1 ELSE 0 END, CASE WHEN w.n > 1 THEN w.at ELSE '' END,
         CASE WHEN w.n > 1 THEN w.idx // 8 ELSE t.idx END, CASE WHEN w.n > 1 THEN (w.n + 7) // 8 ELSE t.n END,
         CASE WHEN w.n > 1 THEN w.proof || k.l || k.r ELSE w.proof END,
         CASE WHEN w.n > 1 THEN sha256(k.l || w.folded || k.r) ELSE w.folded END
  FROM walk w JOIN nodes k ON k.part = w.part AND k.lvl = w.lvl AND k.tree = w.at AND k.idx = w.idx LEFT JOIN tops t ON t.name = w.tree
  WHERE w.n > 1 OR w.part = 0)
SELECT w.doc_id, w.leaf, t.h AS subroot, z.h AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = z.h AS verified
FROM walk w JOIN tops t ON t.name = w.tree JOIN high z ON z.n = 1
WHERE w.part = 1 AND w.n = 1
"""
