"""Operator 5: exact dedup of incoming rows against an immutable snapshot.

Two texts are equal when they are identical after every run of
``[\\x20\\x09-\\x0D]`` is replaced by one space.

1. Every row becomes (id, sha-256 of its normalised text, side); this narrow
   table is checkpointed, the texts are dropped.
2. The snapshot's digests are grouped (partial aggregation first, so a text
   that a third of all rows share is one row per task before any shuffle),
   dealt into buckets by digest prefix, and one static binary fuse filter is
   built for each bucket. A bucket holds a bounded number of keys in the mean,
   as the number of buckets follows the number of digests.
3. The batch's own duplicates are grouped the same way, apart. Its distinct
   digests are screened, bucket by bucket, against the filters: a negative is
   surely new, positives join the snapshot's exact buckets.
4. All digests with more than one row go to the byte check: only their texts
   are read again and grouped by the text itself. Should one digest stand for
   several texts, its rows are classed by text.

Defined cases: null counts as the empty text; of equal texts the row with the
smallest id stays (a null id is larger than any other); of rows that repeat
both id and text just one stays; any extra columns are ignored; either side
may be empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import fuse
from vigil.llm.common import cut, only, read_table

#: Keys of one filter bucket (mean) and the least number of buckets.
BUCKET_KEYS = 8192
MIN_BUCKETS = 64
#: Up to so many digests (32 bytes each) the set of repeated digests is broadcast to the text scan; beyond it they are joined by shuffle.
BROADCAST_ROWS = 200_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays and the number of rows."""
    return rows.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n"))


def _bucket(digest: Column, buckets: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def _keys(digests: pd.Series) -> np.ndarray:
    raw = b"".join(bytes(d).ljust(12, b"\0")[4:12] for d in digests)
    return np.frombuffer(raw, ">u8").astype(np.uint64)


def snapshot_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """(bucket, seed, segment, segments, prints): a static filter for each bucket of the snapshot's digests."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = fuse.build(_keys(pdf["digest"]))
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1].to_numpy(), "seed": [f.seed], "segment": [f.segment], "segments": [f.segments], "prints": [f.prints.tobytes()]})

    return (snapshot.select(_bucket(F.col("digest"), buckets).alias("bucket"), "digest")
            .groupBy("bucket").applyInPandas(build, "bucket int, seed int, segment int, segments int, prints binary"))


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """``incoming`` (distinct digests) with ``hit``: whether the snapshot's filters may hold the digest."""

    def look(inc: pd.DataFrame, fil: pd.DataFrame) -> pd.DataFrame:
        if len(inc) == 0:
            return pd.DataFrame({"digest": pd.Series([], dtype=object), "hit": pd.Series([], dtype=bool)})
        if len(fil) == 0:
            return pd.DataFrame({"digest": inc["digest"], "hit": False})
        f = fil.iloc[0]
        table = fuse.FuseFilter(int(f.seed), int(f.segment), int(f.segments), np.frombuffer(f.prints, np.uint8))
        return pd.DataFrame({"digest": inc["digest"], "hit": fuse.contains(table, _keys(inc["digest"]))})

    left = incoming.select(_bucket(F.col("digest"), buckets).alias("bucket"), "digest").groupBy("bucket")
    return left.cogroup(filters.groupBy("bucket")).applyInPandas(look, "digest binary, hit boolean")


def dedup(docs: DataFrame, incoming: Column, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, incoming.

    ``incoming`` tells the rows of the batch from those of the snapshot; it is
    an expression over the columns doc_id and text. ``digest_bytes`` shortens
    the digest (tests use it to force collisions).
    """
    source = only(docs, doc_id=id_col, text=text_col)
    text = source.select("doc_id", normalised(F.col("text")).alias("norm"), F.coalesce(incoming, F.lit(True)).alias("incoming"))
    rows = cut(text.select("doc_id", "incoming", sha(F.col("norm")).alias("sha"), F.monotonically_increasing_id().alias("row")))
    rows = rows.withColumn("digest", F.substring("sha", 1, digest_bytes) if digest_bytes < 32 else F.col("sha"))

    old = cut(_grouped(rows.where(~F.col("incoming"))))
    new = cut(_grouped(rows.where("incoming")))
    buckets = MIN_BUCKETS
    while buckets * BUCKET_KEYS < old.count():
        buckets *= 2
    flagged = cut(screen(new, snapshot_filters(old, buckets), buckets).where("hit").select("digest"))
    positive = new.join(flagged, "digest", "left_semi")
    matched = old.select("digest", F.col("first").alias("old_first"), F.col("n").alias("old_n")).join(positive, "digest")
    both = cut(matched.select("digest", F.least("old_first", "first").alias("first"), (F.col("old_n") + F.col("n")).alias("n")))
    alone = old.where("n > 1").unionByName(new.where("n > 1")).join(both, "digest", "left_anti")
    groups = cut(both.unionByName(alone.select("digest", "first", "n")))

    # byte check: only the texts behind repeated digests, grouped by the text itself
    wanted = groups.select("digest")
    if groups.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    digest = F.substring(sha(F.col("norm")), 1, digest_bytes)
    texts = text.select("doc_id", "norm", digest.alias("digest")).join(wanted, "digest", "left_semi")
    classes = cut(texts.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n")).select("digest", sha(F.col("norm")).alias("sha")))
    mixed = cut(classes.groupBy("digest").count().where("count > 1").select("digest"))
    if mixed.isEmpty():
        result = rows.join(groups, "digest", "left")
    else:  # rows of these digests are classed by the whole sha of texts that were compared byte by byte
        split = rows.join(mixed, "digest", "left_semi")
        own = split.groupBy("sha").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
        result = rows.join(mixed, "digest", "left_anti").join(groups, "digest", "left").unionByName(split.join(own, "sha"))
    stays = F.coalesce(F.col("first.row") == F.col("row"), F.lit(True))
    return result.select(
        "doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), stays.alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "incoming")


def second_batch() -> Column:
    """How the queries split one table: the ids whose checksum is odd came after the snapshot of the others was frozen."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all of ``documents``, half of it as the frozen snapshot and half as the incoming batch."""
    return dedup(read_table(spark, sf_dir, "documents"), second_batch()).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def distinct_texts(docs: DataFrame, incoming: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, columns unchanged; of rows that repeat id and text one stays."""
    found = dedup(docs, second_batch() if incoming is None else incoming, id_col, text_col)
    gone = cut(found.where("not kept").select(F.col("doc_id").alias("__gone_id"), F.unhex("text_sha256").alias("__gone_sha"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("again")))
    lost = gone.where("not again")
    if lost.count() <= BROADCAST_ROWS:
        lost = F.broadcast(lost)
    key = sha(normalised(F.col(f"`{text_col}`")))
    marked = docs.withColumn("__sha", key)
    out = marked.join(lost, marked[f"`{id_col}`"].eqNullSafe(lost["__gone_id"]) & (marked["__sha"] == lost["__gone_sha"]), "left_anti")
    if not gone.where("again").isEmpty():
        out = out.dropDuplicates([id_col, "__sha"])
    return out.drop("__sha")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of equal texts, columns unchanged."""
    return distinct_texts(docs)


OP5_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
