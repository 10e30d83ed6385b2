"""Operator 8: byte-level BPE encoding and decoding.

The rank file of a byte-level vocabulary is turned into a model of the
``tokenizers`` library: every byte becomes a character (the customary
byte-to-character table), every rank that two tokens merge to becomes a merge.
Texts come in Arrow batches; the matches of the pre-tokenisation pattern that a
worker has not met yet are encoded together by the library, their ids and
offsets kept in a bounded memo.

Decoding reverses the byte table: ids give bytes, never text at once, so a
character whose bytes lie in several tokens comes back whole, and ``decode_text``
holds back the bytes of an unfinished character until the next ids.

Defined cases: null counts as the empty text (no ids); null ids of rows and
repeated rows are returned as they are; an id outside the vocabulary is an
error; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer, models, pre_tokenizers

from vigil.llm.common import map_arrow, only, read_table
from vigil.llm.pieces import Splitter, byte_chars

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces whose ids a worker remembers; the memo is emptied when it is full. Longer pieces are not remembered.
MEMO, MEMO_CHARS = 300_000, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class Codec:
    """Encodes and decodes with one rank file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        ranks = read_ranks(path)
        chars = byte_chars()
        shown = {t: "".join(chars[b] for b in t) for t in ranks}
        merges = []
        for t, _ in sorted(ranks.items(), key=lambda x: x[1]):
            merges += [(shown[t[:k]], shown[t[k:]]) for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.tokenizer = Tokenizer(models.BPE({s: ranks[t] for t, s in shown.items()}, merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.known = np.zeros(len(self.bytes_of), bool)
        for t, r in ranks.items():
            self.bytes_of[r] = t
            self.known[r] = True
        self.split = Splitter(public_tokenizers.PATTERN)
        self.memo: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids (little-endian 32-bit) of pieces, encoded together by the library."""
        got = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return {p: np.array(e.ids, "<u4").tobytes() for p, e in zip(pieces, got)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        memo, out, cut = self.memo, [], self.split
        for text in texts:
            pieces = cut(text)
            new = [p for p in dict.fromkeys(pieces) if p not in memo]
            if new:
                got = self._learn(new)
                if len(memo) + len(got) > MEMO:
                    memo.clear()
                    got = got if len(got) == len(set(pieces)) else self._learn(list(dict.fromkeys(pieces)))
                out.append(b"".join([got[p] if p in got else memo[p] for p in pieces]))
                memo.update((p, x) for p, x in got.items() if len(p) <= MEMO_CHARS)
            else:
                out.append(b"".join([memo[p] for p in pieces]))
        return out

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """(start, end) in code points of each token of a text, end exclusive; of a split character each token has its whole place."""
        out, at = [], 0
        for piece in self.split(text):
            starts = np.cumsum([0] + [len(c.encode("utf-8")) for c in piece])  # first byte of each character
            pos = 0
            for i in np.frombuffer(self.encode([piece])[0], "<u4").tolist():
                end = pos + len(self.bytes_of[i])
                out.append((at + int(np.searchsorted(starts, pos, "right")) - 1, at + int(np.searchsorted(starts, end, "left"))))
                pos = end
            at += len(piece)
        return out

    def decode(self, ids: bytes | Iterable[int]) -> bytes:
        """The bytes of ids (given as numbers, or packed little-endian)."""
        arr = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else np.array(list(ids), np.int64)
        if len(arr) and (arr.max() >= len(self.bytes_of) or arr.min() < 0 or not self.known[arr].all()):
            raise ValueError("an id is not in the vocabulary")
        return b"".join(map(self.bytes_of.__getitem__, arr.tolist()))

    def decode_text(self, parts: Iterable[Iterable[int]], errors: str = "replace") -> Iterator[str]:
        """Text of successive runs of ids; a character that a run leaves unfinished comes with the next one."""
        state = codecs.getincrementaldecoder("utf-8")(errors)
        for part in parts:
            yield state.decode(self.decode(part))
        yield state.decode(b"", final=True)


_CODECS: dict[str, Codec] = {}


def codec(vocabulary: str = VOCABULARY) -> Codec:
    """One codec for each vocabulary and process."""
    if vocabulary not in _CODECS:
        _CODECS[vocabulary] = Codec(public_tokenizers.path(vocabulary))
    return _CODECS[vocabulary]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids of every row; with ``offsets`` also starts and ends (code points) of the tokens, with ``decoded`` the digest of the ids decoded again."""
    source = only(docs, doc_id=id_col, text=text_col)

    def run(batches):
        c = codec(vocabulary)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            packed = list(c.encode(texts))
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in packed]
            cols, names = [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids"]
            if offsets:
                spans = [c.offsets(t) for t in texts]
                cols += [pa.array([[s[k] for s in x] for x in spans], pa.list_(pa.int32())) for k in (0, 1)]
                names += ["starts", "ends"]
            if decoded:
                cols.append(pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in packed], pa.string()))
                names.append("decoded_sha256")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, run, f"doc_id {kind}, n_tokens long, ids array<int>" + (", starts array<int>, ends array<int>" if offsets else "") + (", decoded_sha256 string" if decoded else ""))


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and text of a table of doc_id and ids; bytes that are no UTF-8 become the replacement character, null ids an empty text."""

    def run(batches):
        c = codec(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or []).decode("utf-8", "replace") for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_arrow(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded and its ids decoded again, in one pass."""
    source = only(docs, doc_id=id_col, text=text_col)

    def run(batches):
        c = codec(vocabulary)
        for b in batches:
            ids = c.encode([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in ids], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: ids of every document and of their decoding, as digests."""
    return round_trip(read_table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the ids of every document that is left, and the digest of their decoding."""
    return encode(docs, decoded=True)
