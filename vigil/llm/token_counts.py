"""Operator 6: exact token counts at every prefix by dynamic programming.

For byte-pair encodings a sequence of tokens is the encoding of its text just
when every two neighbours are: merging the bytes of both gives the same two
again. So the last token of the encoding of each prefix can be found from the
shorter prefixes: it is the one token t that ends there and fits behind the last
token of the prefix before t, and ``count[i] = count[i - len(t)] + 1``. Whether
two tokens fit is told by walking up the merge trees along their common border.

The counts of a text's pieces (matches of the pre-tokenisation pattern) add up,
so a text's table is its piece ends and running counts, and within a piece the
counts of all its prefixes. Truncation and budget questions (how many tokens
has this prefix, which prefix still fits) are answered from the table without
encoding again. Counts of pieces are kept in a bounded memo of the worker.

Defined cases: null counts as the empty text (0 bytes, 0 tokens, empty table);
strings of added tokens inside a text count as the library's default has it
(one token); null ids and repeated rows are returned as they are; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_right

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import map_arrow, only, read_table
from vigil.llm.pieces import Splitter, byte_chars

LIMIT = 1024
#: Pieces whose count a worker remembers; the memo is emptied when it is full.
MEMO = 1_000_000
#: Bytes up to which a piece is remembered (longer ones are rare and large).
MEMO_BYTES = 64


class PrefixCounter:
    """Token counts of all prefixes under a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only byte-level vocabularies without normaliser and prefix space are supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or need word bounds are not supported")
        back = {c: b for b, c in byte_chars().items()}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.ids = {bytes(back[c] for c in t): i for t, i in vocab.items() if all(c in back for c in t)}
        self.longest = max(map(len, self.ids))
        size = max(vocab.values()) + 1
        self.rank = [-1] * size
        self.left: list[tuple[int, ...]] = [(i,) for i in range(size)]
        self.right: list[tuple[int, ...]] = [(i,) for i in range(size)]
        self.merge: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(pairs):
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault((x, y), r)
            if self.rank[t] < 0:
                self.rank[t] = r
                self.left[t] = (*self.left[x], t)
                self.right[t] = (*self.right[y], t)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.split = Splitter(public_tokenizers.PATTERN)
        self.memo: dict[str, int] = {}
        self.fit_memo: dict[int, bool] = {}  # by a << 20 | b

    def fits(self, a: int, b: int) -> bool:
        """Whether the text of tokens a and b is encoded as just a and b."""
        xs, ys, rank, merge = self.right[a], self.left[b], self.rank, self.merge
        i = j = 0
        far = len(self.merge) + 1
        while True:
            nx = rank[xs[i + 1]] if i + 1 < len(xs) else far
            ny = rank[ys[j + 1]] if j + 1 < len(ys) else far
            m = merge.get((xs[i], ys[j]), far)
            if m < nx and m <= ny:  # the border is merged before either side grows (of equal ranks the left one goes first)
                ok = False
                break
            if nx == far and ny == far:
                ok = True
                break
            if nx <= ny:
                i += 1
            else:
                j += 1
        if len(self.fit_memo) >= MEMO:
            self.fit_memo.clear()
        self.fit_memo[a << 20 | b] = ok
        return ok

    def prefixes(self, piece: bytes) -> list[int]:
        """Token counts of piece[:0], piece[:1], ... piece[:]."""
        n = len(piece)
        count, last = [0] * (n + 1), [0] * (n + 1)
        ids, fits, longest, known = self.ids.get, self.fits, self.longest, self.fit_memo.get
        for i in range(1, n + 1):
            t = ids(piece[:i]) if i <= longest else None
            if t is not None and (i == 1 or len(self.left[t]) > 1):  # else no merges lead to it
                last[i], count[i] = t, 1
                continue
            for k in range(max(1, i - longest), i):  # long tokens first
                t = ids(piece[k:i])
                if t is not None:
                    ok = known(last[k] << 20 | t)
                    if ok or ok is None and fits(last[k], t):
                        last[i], count[i] = t, count[k] + 1
                        break
        return count

    def piece(self, piece: str) -> int:
        n = self.memo.get(piece)
        if n is None:
            raw = piece.encode("utf-8")
            n = self.prefixes(raw)[-1]
            if len(raw) <= MEMO_BYTES:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[piece] = n
        return n

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text; the string of an added token is a piece of its own."""
        if self.special is None or self.special.search(text) is None:
            return self.split(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self.split(text[at: m.start()]), m.group()]
            at = m.end()
        return out + self.split(text[at:])

    def total(self, pieces: list[str]) -> list[int]:
        if self.special is None:
            return [self.piece(p) for p in pieces]
        return [1 if "<" in p and self.special.fullmatch(p) else self.piece(p) for p in pieces]

    def count(self, text: str) -> int:
        get, memo = self.piece, self.memo
        if self.special is not None and self.special.search(text) is not None:
            return sum(self.total(self.pieces(text)))
        n = 0
        for p in self.split(text):
            c = memo.get(p)
            n += get(p) if c is None else c
        return n

    def table(self, text: str) -> PrefixTable:
        return PrefixTable(self, text)


class PrefixTable:
    """Exact token counts of all prefixes of one text (lengths in code points)."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        self.pieces = counter.pieces(text)
        self.ends = np.cumsum([len(p) for p in self.pieces]).astype(np.int64) if self.pieces else np.zeros(0, np.int64)
        self.counts = np.cumsum(counter.total(self.pieces)).astype(np.int64) if self.pieces else np.zeros(0, np.int64)

    @property
    def total(self) -> int:
        return int(self.counts[-1]) if len(self.counts) else 0

    def _inside(self, k: int) -> list[tuple[int, int]]:
        """(length, tokens) of the prefixes that end inside piece k, its end excluded.

        A piece that is cut short is one piece still, so one table of its
        prefixes answers for all of them, but for three kinds: contractions and
        the strings of added tokens (short ones; what is left of them is cut by
        the pattern together with the piece before), and the space before a
        word, which joins white space before it.
        """
        piece = self.pieces[k]
        head, base = (int(self.ends[k - 1]), int(self.counts[k - 1])) if k else (0, 0)
        added = self.counter.special is not None and self.counter.special.fullmatch(piece)
        if added or piece[0] == "'" and piece[1:].isalpha():
            lead = self.pieces[k - 1] if k else ""
            if lead and self.counter.special is not None and self.counter.special.fullmatch(lead):
                lead = ""
            base = base if not lead else int(self.counts[k - 2]) if k > 1 else 0
            return [(head + c, base + sum(self.counter.total(self.counter.split(lead + piece[:c])))) for c in range(1, len(piece))]
        at, size, out = self.counter.prefixes(piece.encode("utf-8")), 0, []
        for c in range(1, len(piece)):
            size += len(piece[c - 1].encode("utf-8"))
            out.append((head + c, base + at[size]))
        if out and k and piece[0].isspace() and not piece.isspace() and self.pieces[k - 1].isspace():
            before = int(self.counts[k - 2]) if k > 1 else 0
            out[0] = head + 1, before + self.counter.piece(self.pieces[k - 1] + piece[0])
        return out

    def count(self, length: int) -> int:
        """Tokens of the first ``length`` code points."""
        length = min(max(length, 0), len(self.text))
        if length == 0:
            return 0
        k = int(np.searchsorted(self.ends, length))
        if self.ends[k] == length and not self._open(k):
            return int(self.counts[k])
        if self.ends[k] == length:
            first = max(k - 1, 0)
            start, base = (int(self.ends[first - 1]), int(self.counts[first - 1])) if first else (0, 0)
            if self.counter.special is not None and self.counter.special.fullmatch(self.pieces[first]):
                start, base = int(self.ends[first]), int(self.counts[first])
            return base + sum(self.counter.total(self.counter.split(self.text[start:length])))
        return dict(self._inside(k))[length]

    def _open(self, k: int) -> bool:
        """Whether the text cut behind piece k could be split otherwise: white space that met more text."""
        return self.pieces[k].isspace() and k + 1 < len(self.pieces)

    def longest_within(self, budget: int) -> int:
        """The most code points whose prefix has at most ``budget`` tokens."""
        if self.total <= budget:
            return len(self.text)
        k = bisect_right(self.counts, budget)  # piece k is the first whose end exceeds the budget
        best = int(self.ends[k - 1]) if k else 0
        for at in range(k, min(k + 2, len(self.pieces))):  # white space cut short can be one piece instead of two
            for p, n in self._inside(at):
                if n <= budget:
                    best = max(best, p)
            if self._open(at) and self.count(int(self.ends[at])) <= budget:
                best = max(best, int(self.ends[at]))
        return best


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter for each vocabulary file and process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text",
                 tables: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars of every row; with ``tables`` also the table: piece_ends, piece_counts.

    ``fit_chars`` is the greatest number of leading code points that have at
    most ``limit`` tokens. ``vocabulary`` is the name of a file that
    ``public_tokenizers.path`` finds on every worker.
    """
    source = only(docs, doc_id=id_col, text=text_col)
    extra = ", piece_ends array<bigint>, piece_counts array<bigint>" if tables else ""

    def run(batches):
        c = counter(public_tokenizers.path(vocabulary))
        for b in batches:
            size, n, fit, ends, counts = [], [], [], [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                size.append(len(text.encode("utf-8")))
                total = None if tables else c.count(text)
                if tables or total > limit:
                    t = c.table(text)
                    total = t.total
                    fit.append(t.longest_within(limit))
                    ends.append(t.ends)
                    counts.append(t.counts)
                else:
                    fit.append(len(text))
                n.append(total)
            cols = [b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()), pa.array(fit, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
            if tables:
                cols += [pa.array(ends, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))]
                names += ["piece_ends", "piece_counts"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long{extra}")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: exact token counts of every document and the part that fits 1024 tokens."""
    return token_counts(read_table(spark, sf_dir, "documents"))
