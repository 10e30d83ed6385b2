"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from vigil.llm import runs as R


def brute(words):
    """Every run: for each period the maximal stretches, with smaller periods ruled out."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(words[k] == words[k + s] for k in range(i, i + length - s)) for s in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def tail(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(text, doc_id, ruled=True):
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w]
    if ruled and doc_id is not None:
        words = tail(words, doc_id)
    found = brute(words)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def planted(rng):
    words = []
    while len(words) < rng.randint(0, 300):
        unit = [rng.choice("abcdefgh") for _ in range(rng.randint(1, rng.choice([1, 3, 9, 40])))]
        words += unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))]
        words += [rng.choice("abx") for _ in range(rng.randint(0, 4))]
    return [w.encode() for w in words]


def test_runs_equal_brute_force():
    rng = random.Random(7)
    texts = [planted(rng) for _ in range(250)] + [[rng.choice([b"a", b"b"]) for _ in range(rng.randint(0, 90))] for _ in range(250)]
    assert R.runs_of(texts) == [brute(t) for t in texts]
    assert R.runs_of([]) == []


def test_transform_is_exact():
    rng = np.random.default_rng(3)
    for size in (1, 2, 8, 64):
        for top in (2, 50, 1 << 21):
            x, y = rng.integers(0, top, (5, size)), rng.integers(0, top, (5, 2 * size))
            y[0, size // 2: size // 2 + size] = x[0]
            want = [[bool((x[r] == y[r, s: s + size]).all()) for s in range(size)] for r in range(5)]
            assert R.mismatch_free(x, y).tolist() == want


@pytest.mark.parametrize("words", [
    [b"a"] * 100_000, ([b"a"] * 999 + [b"b"]) * 100, [b"w%d" % k for k in range(500)] * 200,
    [b"w%d" % (k * k % 9973) for k in range(100_000)], [b"ab"[k * k % 7 % 2: k * k % 7 % 2 + 1] for k in range(100_000)]])
def test_long_texts_end(words):
    t0 = time.time()
    found = R.runs_of([words])[0]
    assert time.time() - t0 < 20
    for s, n, q in found:
        assert words[s: s + n - q] == words[s + q: s + n]
        assert s == 0 or words[s - 1] != words[s + q - 1]
        assert s + n == len(words) or words[s + n] != words[s + n - q]


def test_query_rows_equal_brute_force(spark):
    got = {r.doc_id: tuple(r) for r in R.op12_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [d for d in docs if len((d.text or "").split()) < 600]
    assert len(got) == len(docs) and len(short) > 100
    for d in short:
        assert got[d.doc_id] == brute_row(d.text, d.doc_id)


def test_defined_cases(spark):
    text = "x " + "go to \t" * 5 + "end"
    rows = [(1, text, 5), (1, text, 6), (None, text, 7), (2, None, 8), (3, "", 9), (4, " \n ", 1), (5, "a " * 6, 2), (6, "a " * 5, 3), (7, "é é " * 8, 4)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, runs int")
    got = sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in R.periodic_runs(docs).collect())
    assert got == sorted([("1", [(1, 10, 2)], "x go to end")] * 2 + [
        ("None", [(1, 10, 2)], "x go to end"), ("2", [], ""), ("3", [], ""), ("4", [], ""), ("5", [(0, 6, 1)], "a"),
        ("6", [], "a a a a a"), ("7", [(0, 8, 1)], "é é")])
    assert R.periodic_runs(docs.limit(0)).collect() == []
    assert R.run_digests(docs.where("doc_id = 2")).first().start is None
