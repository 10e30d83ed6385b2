"""Operator 1: quality classifier, a factorisation machine.

A text becomes a sparse vector of
* hashed words (``WORD_BUCKETS`` slots, square-root counts, scaled to unit length),
* structure statistics (shares, means and lengths, each cut into a few slots
  by linear interpolation), and
* metadata columns (by default the declared length ``n_chars``: its size and
  whether it agrees with the text).

The score is ``sigmoid(w0 + w.x + 1/2 sum_f((V_f.x)^2 - (V_f^2).(x^2)))``: all
pairwise interactions at a cost linear in the non-zero entries, by the
sum-of-squares identity. The model is fitted on the driver from a bounded
sample of labelled rows (``max_train_rows``); scoring reads every whole text in
one pass without a shuffle, the model being a fixed-size broadcast.

Defined cases: a null text counts as empty and gets a score; a null or missing
metadata value has a slot of its own; labels that are null are not learned
from; a document with several labels is learned once for each; repeated rows
are scored each; without any label of one class the score is the share of
label 1 (0.5 without labels). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import chunks, map_arrow, only, read_table, text_buffers, word_hashes

WORD_BUCKETS = 1 << 14
KNOTS = 9
RANK = 6
MAX_TRAIN_ROWS = 6000
THRESHOLD = 0.7
EPOCHS = 40

#: Structure statistics, each with the range that its slots cover.
STATS = {
    "log_bytes": (0.0, 14.0), "log_words": (0.0, 12.0), "mean_word": (0.0, 16.0), "upper_share": (0.0, 1.0),
    "digit_share": (0.0, 0.5), "symbol_share": (0.0, 0.5), "point_share": (0.0, 0.2), "space_share": (0.0, 0.5),
    "line_share": (0.0, 0.05), "distinct_share": (0.0, 1.0), "top_word_share": (0.0, 1.0), "wide_share": (0.0, 0.5),
    "symbol_words": (0.0, 1.0), "same_pair_share": (0.0, 1.0), "brace_share": (0.0, 0.1), "log_meta_chars": (0.0, 14.0),
}
META_SLOTS = 3  # declared length: missing, agrees with the text, differs
N_FEATURES = WORD_BUCKETS + len(STATS) * KNOTS + META_SLOTS

_CLASS = np.zeros(256, np.uint8)  # 1 upper, 2 digit, 3 symbol, 4 sentence point, 5 line end, 6 space, 7 brackets
_CLASS[33:127] = 3
_CLASS[65:91] = 1
_CLASS[97:123] = 0
_CLASS[48:58] = 2
for _c in b".,;:?'-":
    _CLASS[_c] = 4
for _c in b"{}<>[]()=|\\/":
    _CLASS[_c] = 7
_CLASS[10] = 5
_CLASS[[9, 11, 12, 13, 32]] = 6


def _statistics(raw: np.ndarray, words: np.ndarray, width: np.ndarray, has_symbol: np.ndarray, declared: float | None) -> np.ndarray:
    """The values of ``STATS`` of one text."""
    size, n = len(raw), len(words)
    k = np.bincount(_CLASS[raw], minlength=8) if size else np.zeros(8)
    per = 1.0 / max(size, 1)
    _, counts = np.unique(words, return_counts=True)
    per_word = 1.0 / max(n, 1)
    return np.array([
        np.log1p(size), np.log1p(n), width.mean() if n else 0.0, k[1] * per, k[2] * per, k[3] * per, k[4] * per, k[6] * per,
        k[5] * per, len(counts) * per_word, (counts.max() if n else 0) * per_word, (raw >= 128).sum() * per,
        has_symbol.sum() * per_word, (words[1:] == words[:-1]).sum() * per_word, k[7] * per,
        np.log1p(max(declared, 0.0)) if declared is not None else 0.0,
    ])


_LOW = np.array([a for a, _ in STATS.values()])
_SPAN = np.array([b - a for a, b in STATS.values()])


def features(texts: pa.Array, declared: list[float | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, values) of each text."""
    data, offs = text_buffers(texts)
    stat_base = WORD_BUCKETS + np.arange(len(STATS)) * KNOTS
    for i, j in chunks(offs):
        part, po = data[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        h, starts, ends, wo = word_hashes(part, po)
        marks = np.concatenate([[0], np.cumsum(_CLASS[part] == 3)])
        has_symbol = marks[ends] > marks[starts]
        slot = (h >> np.uint64(64 - 14)).astype(np.int64)
        for r in range(j - i):
            a, b = wo[r], wo[r + 1]
            raw = part[po[r]: po[r + 1]]
            meta = declared[i + r]
            idx, tf = np.unique(slot[a:b], return_counts=True)
            val = np.sqrt(tf)
            if len(idx):
                val = val / np.sqrt((val * val).sum())
            x = _statistics(raw, h[a:b], (ends - starts)[a:b], has_symbol[a:b], meta)
            at = np.clip((x - _LOW) / _SPAN, 0.0, 1.0) * (KNOTS - 1)
            left = np.minimum(at.astype(np.int64), KNOTS - 2)
            share = at - left
            chars = len(raw) - int(((raw & 0xC0) == 0x80).sum())
            flag = 0 if meta is None else 1 if meta == chars else 2
            yield (
                np.concatenate([idx, stat_base + left, stat_base + left + 1, [N_FEATURES - META_SLOTS + flag]]),
                np.concatenate([val, 1 - share, share, [1.0]]),
            )


@dataclass
class Machine:
    """A fitted factorisation machine."""

    w0: float
    w: np.ndarray
    v: np.ndarray

    def score(self, idx: np.ndarray, val: np.ndarray) -> float:
        vx = self.v[idx] * val[:, None]
        pair = 0.5 * float((vx.sum(0) ** 2 - (vx * vx).sum(0)).sum())
        z = self.w0 + float(self.w[idx] @ val) + pair
        return float(1.0 / (1.0 + np.exp(-min(max(z, -40.0), 40.0))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 7, epochs: int = EPOCHS, rank: int = RANK,
        rate: float = 0.05, decay: float = 2e-3, batch: int = 128) -> Machine:
    """Logistic loss by Adagrad in small batches; the rarer class weighs as much as half of the commoner one's total."""
    n = len(rows)
    if n == 0 or y.min() == y.max():
        share = min(max(float(y.mean()) if n else 0.5, 0.01), 0.99)
        return Machine(float(np.log(share / (1 - share))), np.zeros(N_FEATURES), np.zeros((N_FEATURES, rank)))
    rng = np.random.default_rng(seed)
    w0, w, v = 0.0, np.zeros(N_FEATURES), rng.normal(0, 0.02, (N_FEATURES, rank))
    g0, gw, gv = 1e-8, np.full(N_FEATURES, 1e-8), np.full((N_FEATURES, rank), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(n)
        for s in range(0, n, batch):
            take = order[s: s + batch]
            idx = np.concatenate([rows[t][0] for t in take])
            val = np.concatenate([rows[t][1] for t in take])
            heads = np.concatenate([[0], np.cumsum([len(rows[t][0]) for t in take])[:-1]])
            doc = np.repeat(np.arange(len(take)), [len(rows[t][0]) for t in take])
            vx = v[idx] * val[:, None]
            total = np.add.reduceat(vx, heads, axis=0)
            z = w0 + np.add.reduceat(w[idx] * val, heads) + 0.5 * (total ** 2 - np.add.reduceat(vx * vx, heads, axis=0)).sum(1)
            err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[take]) / len(take)
            uniq, back = np.unique(idx, return_inverse=True)
            e = err[doc] * val
            dw = np.bincount(back, e, len(uniq)) + decay / len(take) * w[uniq]
            inner = e[:, None] * (total[doc] - vx)
            dv = np.stack([np.bincount(back, inner[:, f], len(uniq)) for f in range(rank)], 1) + decay / len(take) * v[uniq]
            g0 += err.sum() ** 2
            w0 -= rate * err.sum() / np.sqrt(g0)
            gw[uniq] += dw * dw
            w[uniq] -= rate * dw / np.sqrt(gw[uniq])
            gv[uniq] += dv * dv
            v[uniq] -= rate * dv / np.sqrt(gv[uniq])
    return Machine(w0, w, v)


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4 (a null id: no)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _inputs(docs: DataFrame, id_col: str, text_col: str, meta_col: str | None) -> DataFrame:
    df = only(docs, doc_id=id_col, text=text_col, **({"meta": meta_col} if meta_col in docs.columns else {}))
    return df if "meta" in df.columns else df.withColumn("meta", F.lit(None).cast("double"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", meta_col: str | None = "n_chars",
          label_col: str = "quality", max_train_rows: int = MAX_TRAIN_ROWS) -> Machine:
    """Fit on at most ``max_train_rows`` labelled rows that are not held out, half of them of each class if there are as many.

    The sample is the rows of each class with the smallest hash of the id, the
    same at any partitioning. Only these rows' sparse vectors come to the driver.
    """
    lab = only(labels, lab_id=id_col, y=label_col).where(F.col("y").isin(0, 1) & F.col("lab_id").isNotNull() & ~held_out(F.col("lab_id")))
    half = max(max_train_rows // 2, 1)
    order = [F.xxhash64("lab_id"), F.col("lab_id")]
    sample = lab.where("y = 1").orderBy(*order).limit(half).unionByName(lab.where("y = 0").orderBy(*order).limit(half))
    df = _inputs(docs, id_col, text_col, meta_col)
    # the sample is bounded by max_train_rows
    picked = df.join(F.broadcast(sample), F.col("doc_id") == F.col("lab_id")).select("lab_id", "y", "text", F.col("meta").cast("double"))

    def vectors(batches):
        for b in batches:
            got = list(features(b.column(2), b.column(3).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.string()), b.column(1).cast(pa.int32()), pa.array([x.astype(np.int32).tobytes() for x, _ in got], pa.binary()),
                 pa.array([x.astype(np.float32).tobytes() for _, x in got], pa.binary())], ["id", "y", "idx", "val"])

    rows = map_arrow(picked, vectors, "id string, y int, idx binary, val binary").collect()
    rows.sort(key=lambda r: (r.id, r.y, r.idx))
    vecs = [(np.frombuffer(r.idx, np.int32).astype(np.int64), np.frombuffer(r.val, np.float32).astype(float)) for r in rows]
    return fit(vecs, np.array([r.y for r in rows], float))


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text", meta_col: str | None = "n_chars",
          threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    df = _inputs(docs, id_col, text_col, meta_col).select("doc_id", "text", F.col("meta").cast("double"))
    shared = docs.sparkSession.sparkContext.broadcast((model.w0, model.w.astype(np.float32), model.v.astype(np.float32)))

    def scores(batches):
        fm = Machine(*shared.value)
        for b in batches:
            s = [fm.score(i, v) for i, v in features(b.column(1), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return map_arrow(df, scores, f"doc_id {kind}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every document's quality score (see the module for the operator)."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier predicts as good, columns unchanged."""
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return accept(docs, model)


def accept(docs: DataFrame, model: Machine, text_col: str = "text", meta_col: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, columns unchanged: one pass, no join."""
    names = docs.columns
    t = names.index(text_col)
    m = names.index(meta_col) if meta_col in names else None
    shared = docs.sparkSession.sparkContext.broadcast((model.w0, model.w.astype(np.float32), model.v.astype(np.float32)))

    def good(batches):
        fm = Machine(*shared.value)
        for b in batches:
            declared = [None] * b.num_rows if m is None else b.column(m).cast(pa.float64()).to_pylist()
            yield b.filter(pa.array([fm.score(i, v) >= threshold for i, v in features(b.column(t), declared)], pa.bool_()))

    return map_arrow(docs, good, docs.schema)
