import hashlib
import zlib

import pytest

from vigil.llm import sharding as s


def place(number, n, seed):
    """Plain cycle walking, without a bound."""
    a, b = s.domain(n)
    keys = s.round_keys(seed)
    p = s.permute_once(number, a, b, keys)
    while p >= n:
        p = s.permute_once(p, a, b, keys)
    return p


def brute(rows, n_shards=16, seed=42):
    known = []
    for i, t in rows:
        raw = (t or "").encode()
        known.append((i, len(raw) + 1, zlib.crc32(raw)))
    known.sort(key=lambda r: (hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1]}|{r[2]}".encode()).hexdigest(), r[0] is not None))
    out = []
    for k, r in enumerate(known):
        p = place(k, len(known), seed)
        out.append((*r, p % n_shards, p // n_shards))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 97, 1000, 4097])
def test_network_permutes(n):
    a, b = s.domain(n)
    assert n <= a * b <= n + s.MAX_WASTE
    assert sorted(place(k, n, 7) for k in range(n)) == list(range(n))


@pytest.mark.parametrize("rows", [
    [(1, "a")], [(k, f"text {k}") for k in range(997)], [(k, "same") for k in range(300)],
    [(7, "again")] * 120 + [(None, None)] * 40 + [(None, "x"), (3, None), (4, ""), (5, "é" * 30000)],
])
def test_shards_match_brute_force(spark, rows):
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, shard string").repartition(4)
    got = s.shards(df).collect()
    assert sorted([(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got], key=str) == brute(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - (min(map(len, by.values())) if len(by) == 16 else 0) <= 1


def test_empty_table(spark):
    assert s.shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
