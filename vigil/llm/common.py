"""Shared helpers of the training-data operators.

* Vectorised word and shingle hashing over the raw UTF-8 buffers of Arrow
  batches (no per-word Python objects).
* Small Spark helpers: checkpointing into the cluster's shared folder,
  bounded Arrow batches.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

#: Rows of one Arrow batch handed to Python. Long texts make a batch large, so this is far below Spark's default.
BATCH_ROWS = 256
#: Bytes of text that the numpy code works on at once (about 60 bytes of scratch a byte).
CHUNK_BYTES = 1 << 20
U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: One 64-bit value for each byte value, and an odd multiplier with its inverse modulo 2**64.
_BYTE = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_SHINGLE = [U64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(64)]
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, U64(base), U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 row offsets of a string array; a null counts as empty."""
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    _, offs, data = col.buffers()
    if offs is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]: o[-1]], o - o[0]


def chunks(offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK_BYTES; a longer row is a chunk of its own."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + CHUNK_BYTES, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of each row, A-Z lower-cased.

    Returns (64-bit hash, start byte, end byte) of every word, and n + 1
    offsets of the rows into them. The hash of a word is a polynomial in its
    bytes modulo 2**64, mixed with its length, so it does not depend on place.
    """
    size = len(data)
    if size == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    sep = _SPACE[data]
    before = np.empty(size, bool)
    before[0] = True
    before[1:] = sep[:-1]
    heads = offs[:-1]
    before[heads[heads < size]] = True
    starts = np.flatnonzero(before & ~sep)
    before[:-1] = sep[1:]
    before[-1] = True
    tails = offs[1:]
    before[tails[tails > 0] - 1] = True
    ends = np.flatnonzero(before & ~sep) + 1
    acc = np.empty(size + 1, U64)
    acc[0] = 0
    np.cumsum(_BYTE[_LOWER[data]] * _powers(_P, size), out=acc[1:])
    h = (acc[ends] - acc[starts]) * _powers(_PINV, size)[starts]
    h = mix64(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))
    return h, starts, ends, np.searchsorted(starts, offs)


def shingle_hashes(words: np.ndarray, word_offs: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, in order, and n + 1 row offsets.

    A row with 1 to size - 1 words has one shingle: its whole sequence. A row
    without words has none.
    """
    counts = np.diff(word_offs)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_offs = np.concatenate([[0], np.cumsum(n)])
    total = int(out_offs[-1])
    if total == 0:
        return np.zeros(0, U64), out_offs
    row = np.repeat(np.arange(len(counts)), n)
    at = np.arange(total) - out_offs[row] + word_offs[row]
    short = counts[row] < size
    acc = np.zeros(total, U64)
    for k in range(size):
        idx = at + k
        if short.any():
            ok = ~short | (k < counts[row])
            acc[ok] += words[idx[ok]] * _SHINGLE[k]
        else:
            acc += words[idx] * _SHINGLE[k]
    acc += np.minimum(counts[row], size).astype(U64) * U64(0xA0761D6478BD642F)
    return mix64(acc), out_offs


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with Arrow batches bounded in rows, so that long texts do not fill the worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and go on from there (cuts the lineage)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of tables that nothing refers to any more.

    Its cleaner acts on garbage collections of the driver, and a driver with
    little to hold hardly has any; jobs with many rounds call this between them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns under fixed internal names, so that extra or clashing columns cannot interfere."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``docs`` whose id (null included) is in ``kept``, a table of one column named like no other.

    ``kept`` has one row for each kept id. Columns of ``docs`` stay as they are.
    """
    name = "__kept_id"
    right = kept.select(F.col(f"`{kept.columns[0]}`").alias(name))
    return docs.join(right, docs[f"`{id_col}`"].eqNullSafe(right[name]), "left_semi")
