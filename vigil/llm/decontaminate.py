"""Operator 10: benchmark decontamination by greedy string tiling.

Tokens are words (``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased and ASCII
punctuation stripped at both ends; a token of punctuation alone is dropped). A
document is contaminated by a benchmark item when tiles, that is
non-overlapping runs of at least ``min_match`` tokens that both share, cover at
least ``coverage`` of the item's tokens. Tiles may lie in any order, so
reordered passages are caught.

1. The benchmark is read in blocks of bounded size (``block_bytes``); every
   block is a stated query set against all rows, broadcast as the sorted
   hashes of its ``min_match``-token runs (the seeds).
2. One pass over the texts hashes every run of each document and looks it up:
   first in a bit table, then in the sorted seeds. Documents without a seed end
   there.
3. For each (document, item) that shares a seed, the runs of document tokens
   that seeds cover are tiled against the item: the longest common match of
   unmarked tokens is found by Karp-Rabin hashes of all windows of one length
   (the length by bisection, as a common run of length s contains one of
   length s - 1), checked token by token, marked, and so on until no match of
   ``min_match`` tokens is left.

Nothing is shuffled but the findings; a hot document, source or passage is just
more rows of a scan.

Defined cases: null and empty texts match nothing; items with fewer than
``min_match`` tokens match nothing, as so few words prove no copying; items or
rows with a null id are tested like others and carry the null; equal items are
each reported; ties between tiles of one length go to the one that starts first
in the item, then in the document; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import U64, chunks, map_arrow, mix64, only, read_table, text_buffers, word_hashes

MIN_MATCH = 5
COVERAGE = 0.5
#: Bytes of benchmark text that one pass over the documents takes.
BLOCK_BYTES = 8 << 20
BITS = 20

_KR = U64(0x9E3779B185EBCA87)
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all tokens and n + 1 row offsets."""
    if len(data) == 0:
        return np.zeros(0, U64), np.zeros(len(offs), np.int64)
    plain = _strip(data, offs)
    h, _, _, wo = word_hashes(plain, offs)
    return h, wo


def _strip(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The bytes with punctuation at the ends of words turned into spaces."""
    mark = _PUNCT[data]
    if not mark.any():
        return data
    space = (data == 32) | ((data >= 9) & (data <= 13))
    core = ~(mark | space)  # a byte of a word proper
    n = len(data)
    place = np.arange(n)
    edge = np.zeros(n + 1, bool)  # rows end words too
    edge[offs] = True
    wall = np.maximum.accumulate(np.where(space | edge[:n], place, -1))
    last = np.maximum.accumulate(np.where(core, place, -1))
    inside_left = (last >= wall) & (last >= 0) & (~space)  # a core byte stands before (or at) it in this word
    back = slice(None, None, -1)
    shut = np.where(space | edge[1:], place, n)
    wall_r = np.minimum.accumulate(shut[back])[back]
    next_core = np.minimum.accumulate(np.where(core, place, n)[back])[back]
    inside_right = (next_core <= wall_r) & (next_core < n)
    out = data.copy()
    out[mark & ~(inside_left & inside_right)] = 32
    return out


def run_hashes(toks: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` tokens, rolled modulo 2**64."""
    n = len(toks) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    acc = np.zeros(n, U64)
    for k in range(length):
        acc = acc * _KR + toks[k: k + n]
    return acc


def _prefix(toks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes and powers, from which the hash of any run follows in constant time."""
    power = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(len(toks), _KR)]))
    h = np.zeros(len(toks) + 1, U64)
    acc = 0
    for k, t in enumerate(toks.tolist()):
        acc = (acc * int(_KR) + t) & 0xFFFFFFFFFFFFFFFF
        h[k + 1] = acc
    return h, power


def tile(item: np.ndarray, text: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token arrays: tiles (start in item, start in text, length), longest first."""
    tiles: list[tuple[int, int, int]] = []
    if min(len(item), len(text)) < min_match:
        return tiles
    hi, power = _prefix(item)
    ht, power_t = _prefix(text)
    free_i, free_t = np.ones(len(item), bool), np.ones(len(text), bool)

    def windows(h: np.ndarray, pw: np.ndarray, free: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
        gone = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(gone[s:] == gone[:-s]) if len(free) >= s else np.zeros(0, np.int64)
        return at, h[at + s] - h[at] * pw[s]

    def matches(s: int) -> tuple[np.ndarray, np.ndarray, dict]:
        at, ha = windows(hi, power, free_i, s)
        bt, hb = windows(ht, power_t, free_t, s)
        where: dict = {}
        keep = np.isin(hb, ha)
        for b, h in zip(bt[keep].tolist(), hb[keep].tolist()):
            where.setdefault(h, []).append(b)
        return at, ha, where

    low, high = min_match, min(len(item), len(text))
    while True:
        if not matches(low)[2]:
            return tiles
        a, b = low, high
        while a < b:  # the greatest length with a common free run
            mid = (a + b + 1) // 2
            if matches(mid)[2]:
                a = mid
            else:
                b = mid - 1
        at, ha, where = matches(a)
        found = False
        for i, h in zip(at.tolist(), ha.tolist()):
            if not free_i[i: i + a].all():
                continue
            for j in where.get(h, ()):
                if free_t[j: j + a].all() and (item[i: i + a] == text[j: j + a]).all():
                    free_i[i: i + a] = False
                    free_t[j: j + a] = False
                    tiles.append((i, j, a))
                    found = True
                    break
        high = a if found else a - 1
        if high < low:
            return tiles


class Block:
    """One block of the benchmark: tokens of its items and the seeds of all of them."""

    def __init__(self, items: list[tuple[object, str | None]], min_match: int):
        self.min_match = min_match
        self.ids = [i for i, _ in items]
        data, offs = text_buffers(pa.array([t for _, t in items], pa.large_string()))
        toks, to = tokens(data, offs)
        self.items = [toks[to[k]: to[k + 1]] for k in range(len(items))]
        seeds = [mix64(run_hashes(t, min_match)) for t in self.items]
        owner = np.repeat(np.arange(len(items)), [len(s) for s in seeds])
        flat = np.concatenate(seeds) if seeds else np.zeros(0, U64)
        order = np.argsort(flat, kind="stable")
        self.seeds, self.owner = flat[order], owner[order]
        self.table = np.zeros(1 << BITS, bool)
        self.table[(self.seeds >> U64(64 - BITS)).astype(np.int64)] = True

    def find(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, covered tokens, tiles, longest tile) of all rows and items that share a seed."""
        data, offs = text_buffers(texts)
        m = self.min_match
        for i, j in chunks(offs):
            toks, to = tokens(data[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
            runs = mix64(run_hashes(toks, m))
            hit = np.flatnonzero(self.table[(runs >> U64(64 - BITS)).astype(np.int64)])
            left = np.searchsorted(self.seeds, runs[hit], "left")
            right = np.searchsorted(self.seeds, runs[hit], "right")
            row = np.searchsorted(to, hit, "right") - 1
            ok = (right > left) & (hit + m <= to[row + 1])
            hit, left, right, row = hit[ok], left[ok], right[ok], row[ok]
            for r in np.unique(row).tolist():
                mine = row == r
                spots: dict[int, list[int]] = {}
                for p, a, b in zip(hit[mine].tolist(), left[mine].tolist(), right[mine].tolist()):
                    for k in set(self.owner[a:b].tolist()):
                        spots.setdefault(k, []).append(p)
                for k in sorted(spots):
                    at = np.array(spots[k])
                    cover = np.unique((at[:, None] + np.arange(m)).ravel())
                    breaks = np.flatnonzero(np.diff(cover) > 1) + 1
                    parts: list[np.ndarray] = []
                    for n, seg in enumerate(np.split(cover, breaks)):
                        parts += [toks[seg], np.array([n + 1], U64)]  # a token that no item has stands between segments
                    got = tile(self.items[k], np.concatenate(parts), m)
                    if got:
                        yield i + r, k, sum(t[2] for t in got), len(got), got[0][2]


def blocks(benchmark: DataFrame, min_match: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark's items, a bounded number of bytes at a time."""
    items, size = [], 0
    for r in benchmark.toLocalIterator():
        items.append((r.item_id, r.text))
        size += len(r.text or "") * 4
        if size >= block_bytes:
            yield Block(items, min_match)
            items, size = [], 0
    if items:
        yield Block(items, min_match)


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Contaminated pairs: doc_id, item_id, item_tokens, covered_tokens, tiles, longest_tile, coverage."""
    source = only(docs, doc_id=id_col, text=text_col)
    items = only(benchmark, item_id=item_col, text=item_text_col)
    kind, item_kind = source.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType
    schema = f"doc_id {kind}, item int, item_tokens int, covered_tokens int, tiles int, longest_tile int"
    spark, found = docs.sparkSession, []
    for block in blocks(items, min_match, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            b = shared.value
            for batch in batches:
                got = [(r, k, n, c, top) for r, k, n, c, top in b.find(batch.column(1)) if n >= coverage * len(b.items[k])]
                rows = pa.array([g[0] for g in got], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), *[pa.array(x, pa.int32()) for x in zip(*[(k, len(b.items[k]), n, c, top) for _, k, n, c, top in got])]]
                    if got else [batch.column(0).slice(0, 0)] + [pa.array([], pa.int32())] * 5,
                    ["doc_id", "item", "item_tokens", "covered_tokens", "tiles", "longest_tile"])

        names = spark.createDataFrame([(k, i) for k, i in enumerate(block.ids)], f"item int, item_id {item_kind.simpleString()}")
        # the names are those of one block, so bounded by block_bytes
        found.append(map_arrow(source, run, schema).join(F.broadcast(names), "item").select(
            "doc_id", "item_id", "item_tokens", "covered_tokens", "tiles", "longest_tile", (F.col("covered_tokens") / F.col("item_tokens")).alias("coverage")))
    if not found:
        return spark.createDataFrame([], f"doc_id {kind}, item_id {item_kind.simpleString()}, item_tokens int, covered_tokens int, tiles int, longest_tile int, coverage double")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every (document, benchmark item) whose tiles cover at least half of the item."""
    return overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that no benchmark item contaminates, columns unchanged: a filter of the scan for each block, no join."""
    at = docs.columns.index(text_col)
    for block in blocks(only(benchmark, item_id="item_id", text="text"), min_match, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            b = shared.value
            for batch in batches:
                bad = np.zeros(batch.num_rows, bool)
                for r, k, n, _, _ in b.find(batch.column(at)):
                    bad[r] |= n >= coverage * len(b.items[k])
                yield batch.filter(pa.array(~bad))

        docs = map_arrow(docs, run, docs.schema)
    return docs


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a benchmark passage, columns unchanged."""
    return clean(docs, read_table(spark, sf_dir, "benchmark"))
