"""Operator 11: best-two-fit packing of token sequences.

1. One scan encodes every text and cuts it into pieces of at most ``capacity``
   tokens; of a piece only its place, length and checksum go on (or, for
   ``sequences``, its ids).
2. Pieces are interchangeable by length, so the packing is planned on the count
   of pieces by length: at most ``capacity`` numbers, whatever the corpus.
   ``plan`` fills a sequence greedily, the longest piece that fits first; when
   nothing fits any more, the smallest piece in it is exchanged for two unpacked
   ones that fill its expanded gap best, as long as that makes the gap smaller.
   As the choice depends only on which lengths are left, the same filling is
   repeated until one of its lengths runs short: a plan has few distinct
   fillings, each with a number of repeats.
3. A range shuffle on (length, place in the input) numbers the pieces of each
   length: the place in its sorted partition plus the counts of earlier
   partitions. The number tells the filling, the repeat and the place in it, so
   each piece finds its sequence and offset alone. No window or group holds the
   pieces of one length.

Defined cases: a null text is empty and has one token (the end mark); null ids
and repeated rows are packed like others; a text longer than ``capacity`` is cut
and only then; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from vigil.llm.common import cut, map_arrow, only, read_table
from vigil.llm.pieces import Splitter, byte_chars
from vigil.session import shuffle_partitions

VOCABULARY = "word_bpe_49k.json"
CAPACITY, END_ID = 4096, 1
#: Words whose ids a worker remembers; the memo is emptied when it is full. Longer words are not remembered.
MEMO, MEMO_BYTES = 1_000_000, 64
#: A byte that no word has which is learned together with others.
MARK = "\0"


class WordEncoder:
    """Ids of texts under a lower-casing vocabulary with word ends, whose pre-tokenisation never joins what white space parts.

    The words between ASCII white space are encoded once and remembered. New
    ones are encoded together: normalised (by the library unless they are ASCII),
    cut by the vocabulary's own pattern, and given to a tokenizer with the
    vocabulary's merges that only parts at spaces, with a mark between words to
    tell their ids apart. Words with the string of an added token, with control
    characters, or with code points that the pattern engines class differently go
    through the vocabulary's whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]], [x["type"] for x in steps]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or steps[0]["behavior"] != "Removed" or spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError("only vocabularies of lower-cased words with word ends are supported")
        self.whole = Tokenizer.from_file(path)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.parts = Tokenizer(models.BPE(vocab, merges, end_of_word_suffix="</w>"))
        self.parts.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        chars = byte_chars()
        self.mark = vocab[chars[ord(MARK)] + "</w>"]
        splitter = Splitter(steps[0]["pattern"]["Regex"])
        self.find, self.disputed = splitter.find, splitter.disputed
        self.odd = regex.compile("|".join([r"[\x00-\x1f\x7f]", *[regex.escape(t["content"]) for t in spec["added_tokens"]]]))
        self.bytes = str.maketrans({chr(b): c for b, c in chars.items() if b != 32})
        self.memo: dict[bytes, bytes] = {}

    def _parts(self, words: list[str], normal: Callable[[str], str] | None) -> str | None:
        """The parts of normalised words, parted by spaces, with ``MARK`` before each word but the first; None if a word is split or joined by it.

        Without ``normal`` the words are ASCII letters, each one part.
        """
        if normal is None:
            return f" {MARK} ".join(words).lower()
        line = normal(" ".join(words))
        if line.count(" ") != len(words) - 1 or self.disputed is not None and not line.isascii() and self.disputed.search(line):
            return None
        return " ".join(self.find(line.replace(" ", f" {MARK} ")))

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        line, got = b" ".join(words).decode("utf-8"), {}
        texts = line.split(" ")
        any_odd = self.odd.search(line) is not None
        # 0: ASCII letters, 1: other ASCII, 2: the rest, 3: for the whole tokenizer
        kinds = [(0 if t.isalpha() else 3 if any_odd and self.odd.search(t) else 1) if t.isascii() else 3 if any_odd and self.odd.search(t) else 2 for t in texts]
        odd = [t for t, k in zip(texts, kinds) if k == 3]
        for kind, normal in ((0, None), (1, str.lower), (2, self.whole.normalizer.normalize_str)):
            group = [t for t, k in zip(texts, kinds) if k == kind]
            if not group:
                continue
            line = self._parts(group, normal)
            if line is None:  # one by one, to find out which
                single = [(t, self._parts([t], normal)) for t in group]
                odd += [t for t, x in single if x is None]
                group, line = [t for t, x in single if x is not None], f" {MARK} ".join([x for _, x in single if x is not None])
                if not group:
                    continue
            shown = line.replace(MARK, self.bytes[0]) if line.isascii() else line.encode("utf-8").decode("latin-1").translate(self.bytes)
            ids = np.array(self.parts.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
            marks = 4 * np.flatnonzero(ids == self.mark)
            packed = ids.tobytes()
            each = [packed[a:b] for a, b in zip([0, *(marks + 4).tolist()], [*marks.tolist(), len(packed)])]
            got.update(zip([t.encode("utf-8") for t in group], each, strict=True))
        got.update((t.encode("utf-8"), np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()) for t in odd)
        return got

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        gc.disable()  # many lists of words and no cycles: passes over them would find nothing
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        words = set(chain.from_iterable(split))
        here = dict(zip(words, map(self.memo.get, words)))  # small enough to stay near the processor
        new = [w for w, x in here.items() if x is None]
        if new:
            got = self._learn(new)
            here.update(got)
            if len(self.memo) >= MEMO:
                self.memo = {}
            self.memo.update((w, x) for w, x in got.items() if len(w) <= MEMO_BYTES)
        return [b"".join(map(here.__getitem__, w)) for w in split]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> WordEncoder:
    """One encoder for each vocabulary and process."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(public_tokenizers.path(vocabulary))
    return _ENCODERS[vocabulary]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (with ``with_ids`` also ids) of the pieces of every text."""
    source = only(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        e = encoder(vocabulary)
        for b in batches:
            row, nth, size, crc, ids = [], [], [], [], []
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for k, packed in enumerate(e.encode(texts)):
                packed += end
                for i, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at: at + 4 * capacity]
                    row.append(k)
                    nth.append(i)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            n = np.array(nth, np.int64)
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(n.astype(np.int32)), pa.array(n * capacity), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    return map_arrow(source, run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


class _Lengths:
    """Counts by length, with the lengths that are left in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n > 0}
        self.order = sorted(self.counts)

    def at_most(self, size: int) -> int:
        """Index behind the last length of at most ``size``."""
        return bisect_right(self.order, size)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.order.pop(bisect_right(self.order, length) - 1)


def _fill(left: _Lengths, capacity: int) -> dict[int, int]:
    """Lengths and how often they are in the next sequence: greedy, the longest that fits first."""
    used: dict[int, int] = {}
    gap, k = capacity, left.at_most(capacity)
    while k and gap:
        length = left.order[k - 1]
        n = min(left.counts[length], gap // length)
        used[length] = n
        gap -= n * length
        k = min(k - 1, left.at_most(gap))
    return used


def _two(left: _Lengths, used: dict[int, int], least: int, most: int) -> tuple[int, int] | None:
    """The two unpacked lengths whose sum is greatest in (least, most]."""
    order, best, sum_best = left.order, None, least

    def free(length: int) -> int:
        return left.counts[length] - used.get(length, 0)

    i, j = 0, left.at_most(most) - 1
    while i <= j:
        x, y = order[i], order[j]
        if free(x) <= 0 or (x == y and free(x) < 2):
            i += 1
        elif free(y) <= 0 or x + y > most:
            j -= 1
        else:
            if x + y > sum_best:
                best, sum_best = (x, y), x + y
                if sum_best == most:
                    break
            i += 1
    return best


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(filling, repeats): how many pieces of each length a sequence takes, and how many sequences are filled so."""
    if any(k < 1 or k > capacity for k in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    left, out = _Lengths(counts), []
    while left.order:
        used = _fill(left, capacity)
        gap = capacity - sum(k * n for k, n in used.items())
        while gap:
            small = min(used)
            two = _two(left, used, small, small + gap)
            if two is None:
                break
            used[small] -= 1
            if not used[small]:
                del used[small]
            for length in two:
                used[length] = used.get(length, 0) + 1
            gap += small - sum(two)
        times = min(left.counts[k] // n for k, n in used.items())
        for k, n in used.items():
            left.take(k, n * times)
        out.append((used, times))
    return out


def places(fillings: Iterable[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan by piece: for each length, from which number on its pieces go to which sequences, and at what offset in them."""
    rows, taken, sequence = [], {}, 0
    for used, times in fillings:
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            rows.append((length, taken.get(length, 0), sequence, n, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "each", "offset"), table.T))


def _locate(at: dict[str, np.ndarray], length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and numbers (from 0) in them."""
    lo, hi = np.searchsorted(at["length"], length, "left"), np.searchsorted(at["length"], length, "right")
    while (open_ := hi - lo > 1).any():  # halving, for all pieces at once
        mid = (lo + hi) // 2
        up = open_ & (at["first"][mid] <= number)
        lo, hi = np.where(up, mid, lo), np.where(open_ & ~up, mid, hi)
    behind = number - at["first"][lo]
    return at["sequence"][lo] + behind // at["each"][lo], at["offset"][lo] + behind % at["each"][lo] * length


def pack(items: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``items`` with sequence_id and offset: sequences of at most ``capacity``, offsets without gaps from 0.

    ``items`` may have any other columns; its lengths are from 1 to ``capacity``.
    """
    spark = items.sparkSession
    if taken := {"sequence_id", "offset"} & set(items.columns):
        raise ValueError(f"columns are taken: {sorted(taken)}")
    base = cut(items.withColumns({"__size": F.col(f"`{length}`").cast("long"), "__tie": F.monotonically_increasing_id()}))
    counts = {r["__size"]: r["n"] for r in base.groupBy("__size").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    at = places(plan(counts, capacity))
    placed = base.repartitionByRange(shuffle_partitions(spark), "__size", "__tie").sortWithinPartitions("__size", "__tie")
    placed = cut(placed.drop("__tie").withColumn("__at", F.monotonically_increasing_id()))  # partition number * 2**33 + place
    part = F.shiftright("__at", 33)
    sizes = placed.groupBy(part.alias("__p"), F.col("__size").alias("__s")).agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("__s").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # at most one row for each partition
    shift = sizes.select("__p", "__s", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("__shift"))
    ranked = placed.join(shift, (part == F.col("__p")) & (F.col("__size") == F.col("__s"))).withColumn("__number", F.col("__at") + F.col("__shift"))
    kept = ranked.select(*items.columns, "__size", "__number")
    schema = items.schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        for b in batches:
            where = _locate(at, *[b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("__size", "__number")])
            cols = b.columns[:-2] + [pa.array(x, pa.int64()) for x in where]
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names[:-2], "sequence_id", "offset"])

    return map_arrow(kept, run, schema)


def sequences(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids, and docs, the (doc_id, piece, offset, length) of their pieces in order."""
    packed = pack(pieces(docs, capacity, end_id, vocabulary, id_col, text_col, with_ids=True), capacity)
    whole = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids"))).alias("p"))  # at most ``capacity`` tokens
    return whole.select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"), F.flatten("p.ids").alias("ids"),
                        F.transform("p", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("docs"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all documents packed into sequences of 4096 tokens."""
    return pack(pieces(read_table(spark, sf_dir, "documents")))
