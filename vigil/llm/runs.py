"""Operator 12: periodic runs of words by block convolution.

A run is a stretch of consecutive words with smallest period q and at least
max(6, 4q) words that no neighbouring word extends with period q.

For each dyadic scale B = 1, 2, 4, ... a text is cut into blocks of B words,
and each block is compared with the following window at the distances B to
2B - 1 at once: the squared differences of the word numbers, summed over the
block, are one cyclic convolution of 2B numbers by number-theoretic transform
(NTT). The sums are exact: they are taken modulo as many primes as their bound
needs, and are zero just where all residues are. A run of period q, B <= q < 2B,
holds a whole block in its first 2B - 1 words, and at least 4q words; so the
first block meets its copy at distance q with no mismatch. Such distances seed
an extension to both sides, word by word.

Two exact tests spare transforms whose result is known. (1) In the run all words
of the block and of the next one come again within fewer than 2B words; a block
with a word that does not cannot be the first of a run. (2) Inside a known run
of period p all meetings of a block are multiples of p, no smallest periods.

Words of a text are numbered by their first place, so equality is exact.
Several texts are worked on together, up to ``CHUNK_WORDS`` words or one longer
text; memory grows with that, not with the batch.

Defined cases: a null text has no words; a null id is returned as it is; texts
are whole, of any length; repeated rows are each returned; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import map_arrow, only, read_table

LEAST_LENGTH, LEAST_POWER = 6, 4
#: Words that are worked on together, and numbers of one batch of transforms.
CHUNK_WORDS, BATCH_NUMBERS = 1 << 18, 1 << 19
#: (prime, primitive root); each prime is c * 2**k + 1 with k of at least 25, so blocks of up to 2**24 words can be transformed.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
U64 = np.uint64
_ROOTS: dict[tuple[int, int, bool], np.ndarray] = {}


def _roots(prime: int, root: int, size: int, inverse: bool) -> np.ndarray:
    """The powers 0 to size/2 - 1 of a root of unity of order ``size``."""
    key = (prime, size, inverse)
    if key not in _ROOTS:
        w = pow(root, (prime - 1) // size, prime)
        if inverse:
            w = pow(w, -1, prime)
        out = np.ones(max(size // 2, 1), U64)
        done, step = 1, w
        while done < size // 2:  # doubling: the next half is the first times w ** done
            out[done: 2 * done] = out[:done] * U64(step) % U64(prime)
            done, step = 2 * done, step * step % prime
        _ROOTS[key] = out
    return _ROOTS[key]


def transform(x: np.ndarray, prime: int, root: int, inverse: bool = False) -> np.ndarray:
    """NTT of each row of ``x`` (residues, a power of two of columns), by autosorting halving steps."""
    rows, n = x.shape
    p = U64(prime)
    y = x.reshape(rows, n, 1)
    half = n // 2
    while half:
        w = _roots(prime, root, 2 * half, inverse)[None, :, None]
        a, b = y[:, :half, :], y[:, half:, :]
        up = a + b
        up = np.where(up >= p, up - p, up)
        down = (a + (p - b)) * w % p
        y = np.empty((rows, half, 2 * a.shape[2]), U64)
        y[:, :, : a.shape[2]], y[:, :, a.shape[2]:] = up, down
        half //= 2
    y = y.reshape(rows, n)
    if inverse:
        y = y * U64(pow(n, -1, prime)) % p
    return y


def mismatch_free(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether each row of ``blocks`` (r, B) equals ``windows`` (r, 2B) at each shift 0 to B - 1: an (r, B) table.

    Numbers are at least 0. The sums of squared differences are found modulo
    primes whose product exceeds their bound B * max**2.
    """
    rows, size = blocks.shape
    bound = size * max(int(blocks.max(initial=0)), int(windows.max(initial=0))) ** 2
    zero = np.ones((rows, size), bool)
    done = 1
    for prime, root in PRIMES:
        p = U64(prime)
        x, y = blocks.astype(U64) % p, windows.astype(U64) % p
        flipped = np.zeros((rows, 2 * size), U64)
        flipped[:, 0] = x[:, 0]
        flipped[:, size + 1:] = x[:, :0:-1]  # place -i mod 2B holds x[i]: a product of transforms correlates
        product = transform(flipped, prime, root) * transform(y, prime, root) % p
        cross = transform(product, prime, root, inverse=True)[:, :size]
        squares = np.zeros((rows, 2 * size + 1), U64)
        np.cumsum(y * y % p, axis=1, out=squares[:, 1:])
        own = (x * x % p).sum(axis=1, keepdims=True) % p
        window = (squares[:, size: 2 * size] - squares[:, :size]) % p
        zero &= (own + window) % p == (cross + cross) % p
        done *= prime
        if done > bound:
            return zero
    raise ValueError("a block is too long for the primes")


def _first_false(same: Callable[[int, int], np.ndarray], limit: int) -> int:
    """How many leading places of a lazily compared stretch agree; pieces double in size."""
    at, step = 0, 64
    while at < limit:
        got = same(at, min(limit, at + step))
        if not got.all():
            return at + int(np.argmin(got))
        at, step = min(limit, at + step), step * 2
    return limit


def _extend(words: np.ndarray, lo: int, hi: int, pos: int, d: int) -> tuple[int, int]:
    """The stretch [a, e) of ``words[lo:hi]`` around pos in which words d apart are identical."""
    right = _first_false(lambda x, y: words[pos + x: pos + y] == words[pos + d + x: pos + d + y], hi - d - pos)
    left = _first_false(lambda x, y: (words[pos - y: pos - x] == words[pos + d - y: pos + d - x])[::-1], pos - lo)
    return pos - left, pos + right + d


def _smallest(words: np.ndarray, a: int, d: int) -> bool:
    """Whether the period d of the stretch at a is its smallest (no proper divisor of d is one)."""
    n, f = d, 2
    divisors = set()
    while f * f <= n:
        while n % f == 0:
            divisors.add(f)
            n //= f
        f += 1
    if n > 1:
        divisors.add(n)
    return not any(np.array_equal(words[a: a + d], words[a + d // f: a + d + d // f]) for f in divisors)


def _place(run: tuple[int, int, int]) -> tuple[int, int]:
    return run[0], run[2]


def find_runs(words: np.ndarray, offs: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start and period.

    ``words`` are numbers below the text's own word count, equal just for equal
    words; text k is ``words[offs[k]:offs[k + 1]]``.
    """
    n_texts, total = len(offs) - 1, len(words)
    sizes = np.diff(offs)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(n_texts)]
    if total == 0 or sizes.max() < LEAST_LENGTH:
        return found
    apart = words + np.repeat(offs[:-1], sizes)  # texts share no number
    order = np.argsort(apart, kind="stable")
    gap = np.full(total, np.iinfo(np.int32).max, np.int32)  # distance to the same word's next place
    a, b = order[:-1], order[1:]
    same = apart[a] == apart[b]
    gap[a[same]] = (b - a)[same]
    widest = np.maximum(gap[:-1], gap[1:]) if total > 1 else gap[:0]  # over 2 * scale words from each place
    scale = 1
    while 4 * scale <= sizes.max():
        long = np.flatnonzero(sizes >= max(LEAST_LENGTH, 4 * scale))
        counts = (sizes[long] - 2 * scale) // scale + 1
        text = np.repeat(long, counts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        pos = offs[text] + nth * scale
        keep = widest[pos] < 2 * scale
        if keep.any():
            _one_scale(words, offs, text[keep], pos[keep], scale, found)
        if 2 * scale >= len(widest):
            break
        widest = np.maximum(widest[: len(widest) - 2 * scale], widest[2 * scale:])
        scale *= 2
    return [sorted(runs, key=_place) for runs in found]


def _probe(words: np.ndarray, pos: np.ndarray, d: np.ndarray, end: np.ndarray, scale: int) -> np.ndarray:
    """Which meetings can be those of a run's first block: there the words from pos to pos + 3d - scale meet their copies too. A few places are looked at."""
    left = np.flatnonzero(pos + 4 * d - scale < end)
    for part in range(1, 9):
        at = pos[left] + scale + (3 * d[left] - 2 * scale) * part // 8
        left = left[words[at] == words[at + d[left]]]
    return left


def _one_scale(words: np.ndarray, offs: np.ndarray, text: np.ndarray, pos: np.ndarray, scale: int, found: list) -> None:
    """Add the runs with scale <= period < 2 * scale whose first block is among those at ``pos``."""
    known: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # by position: runs from before the block to behind it
    far = offs[text + 1]
    spare = np.zeros(len(pos), bool)
    for t in np.unique(text):
        here, lo = np.arange(*np.searchsorted(text, [t, t + 1])), int(offs[t])
        for start, length, q in found[t]:
            if length >= 2 * scale:
                i, j = np.searchsorted(pos[here], [lo + start, lo + start + length - 2 * scale + 1])
                inside = here[i:j]
                whole = lo + start + length >= np.minimum(far[inside], pos[inside] + 3 * scale - 1)
                spare[inside[whole]] = True
                for k in inside[~whole]:
                    known[int(k)].append((lo + start, lo + start + length, q))
    rows = np.flatnonzero(~spare)
    span = max(1, BATCH_NUMBERS // (2 * scale))
    done: dict[tuple[int, int], int] = {}  # (text, distance): end of the last stretch looked at
    for at in range(0, len(rows), span):
        part = rows[at: at + span]
        p, end = pos[part], far[part]
        block = words[p[:, None] + np.arange(scale)]
        place = p[:, None] + np.arange(scale, 3 * scale)
        beyond = place >= end[:, None]
        # a number that no word has stands behind the text
        window = np.where(beyond, int((end - offs[text[part]]).max()), words[np.minimum(place, len(words) - 1)])
        zero = mismatch_free(block, window)
        row, shift = np.nonzero(zero)
        hopeful = _probe(words, p[row], shift + scale, end[row], scale)
        for i, d in zip(row[hopeful].tolist(), (shift[hopeful] + scale).tolist()):
            k = int(part[i])
            t, x = int(text[k]), int(pos[k])
            if done.get((t, d), -1) > x + d or any(d % q == 0 and stop >= x + scale + d for _, stop, q in known.get(k, ())):
                continue
            lo, hi = int(offs[t]), int(offs[t + 1])
            a, e = _extend(words, lo, hi, x, d)
            done[t, d] = e
            if e - a >= max(LEAST_LENGTH, LEAST_POWER * d) and _smallest(words, a, d):
                found[t].append((a - lo, e - a, d))


def split_words(text: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` (just what ``bytes.split`` takes as white space)."""
    return text.split()


def rewrite_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The query's rule: of ids whose checksum ends in 0, the words from place a on repeat with period p."""
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a: a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int32)
    for start, length, q in runs:
        drop[start + q] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop)
    return [w for w, x in zip(words, gone.tolist()) if not x]


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; of equal ones the first, then that of the smallest period."""
    best = None
    for run in sorted(runs, key=_place):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _grouped(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= CHUNK_WORDS):
            n += len(texts[j])
            j += 1
        yield i, j
        i = j


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of texts that are given as their words."""
    out = []
    for i, j in _grouped(texts):
        numbers, offs = [], [0]
        for words in texts[i:j]:
            first: dict[bytes, int] = {}
            numbers.append(np.array(list(map(first.setdefault, words, range(len(words)))), np.int64))
            offs.append(offs[-1] + len(words))
        out += find_runs(np.concatenate(numbers), np.array(offs, np.int64))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Callable | None = None) -> DataFrame:
    """doc_id, runs (start, length, period: word numbers) and collapsed (the words that are left, joined by one space) of every row.

    ``rule`` may change the list of words (bytes) of a row, given the list and the id.
    """
    source = only(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for ids, words, runs in _batches(batches, rule):
            listed = [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs]
            kept = [b" ".join(collapse(w, r)).decode("utf-8") for w, r in zip(words, runs)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(listed, pa.list_(struct)), pa.array(kept, pa.string())], ["doc_id", "runs", "collapsed"])

    return map_arrow(source, run, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _batches(batches, rule):
    """(ids, words, runs) of groups of rows of at most ``CHUNK_WORDS`` words, or of one longer row."""
    for b in batches:
        at = 0
        raw = b.column(1).cast(pa.binary())
        ids = b.column(0).to_pylist() if rule else None
        while at < b.num_rows:
            words, n, start = [], 0, at
            while at < b.num_rows and n < CHUNK_WORDS:
                w = split_words(raw[at].as_py() or b"")
                if rule:
                    w = rule(w, ids[at])
                words.append(w)
                n += len(w)
                at += 1
            yield b.column(0).slice(start, at - start), words, runs_of(words)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Callable | None = None) -> DataFrame:
    """Like ``periodic_runs``, with the best run and digests in place of the lists."""
    source = only(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def run(batches):
        for ids, words, runs in _batches(batches, rule):
            rows = []
            for w, r in zip(words, runs):
                best = best_run(r)
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in r)
                rows.append((len(r), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
                             hashlib.sha256(b" ".join(collapse(w, r))).hexdigest()))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.int64()) for c in cols[:5]], *[pa.array(c, pa.string()) for c in cols[5:]]], names)

    return map_arrow(source, run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the periodic runs of every document, with the tails of one tenth of them made periodic."""
    return run_digests(read_table(spark, sf_dir, "documents"), rule=rewrite_tail)
