import itertools
import random
import re

import pytest

from vigil.llm import near_dedup as nd
from vigil.llm.components import components


def shingles(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in raw))
    return {tuple(words[k: k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    comp = {i: i for i in sets if i is not None}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in itertools.combinations(sorted(comp), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            lo, hi = sorted((root(a), root(b)))
            comp[hi] = lo
    return {i: root(i) for i in comp}


def corpus(seed=1):
    r = random.Random(seed)
    rows = []
    for g in range(12):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice((6, 30, 90, 300)))]
        for _ in range(r.randint(1, 14)):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 25))):
                words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
            rows.append(" ".join(words))
    rows += ["", None, " \n", "one", "ONE", "one two", "é é é é é é", "é é é é é", "a " * 3000, "a " * 9, "A\ta\na a a"]
    order = list(range(len(rows)))
    r.shuffle(order)
    return [(k, rows[j]) for k, j in enumerate(order)]


@pytest.mark.parametrize("percent", [80, 85])
def test_components_match_brute_force(spark, percent):
    rows = corpus(percent)
    rows += [rows[5], (None, "one"), (None, rows[3][1])]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, bands string").repartition(5)
    got = nd.near_dedup(df, percent).collect()
    want = brute(rows, percent)
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(len(shingles(t)))
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.n_shingles in texts[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)
    kept = nd.representatives(df, percent)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {None} | {i for i, c in want.items() if i == c}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_dedup(df).count() == 0
    assert nd.representatives(df).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}}


def test_repeated_id_with_another_text_stays(spark):
    a, b = "one two three four five six seven", "quite another text that resembles nothing else at all"
    rows = [(1, a, 0), (2, a.upper(), 1), (2, b, 2), (3, a, 3), (4, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(2)
    assert sorted(r.n for r in nd.representatives(df).collect()) == [0, 2, 4]


def near_group(n, chained, seed=1):
    """n near copies of a text of 150 words; with ``chained`` each is made from an earlier one."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(150)]
    out = []
    for _ in range(n):
        words = list(r.choice(out) if chained and out else base)
        for _ in range(r.randint(0, 8)):
            words[r.randrange(150)] = f"x{r.randrange(10 ** 6)}"
        out.append(words)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("chained", [False, True])
def test_large_group_compares_few_pairs(spark, monkeypatch, chained):
    texts = near_group(400, chained)
    asked, real = [], nd.confirmed

    def confirmed(pairs, sets, percent):
        asked.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(nd, "confirmed", confirmed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in nd.near_dedup(df, 80).collect()}
    assert got == brute(list(enumerate(texts)), 80)
    assert sum(asked) < 15 * len(texts)  # all pairs would be 79,800


def test_bitmaps_rule_out_no_link(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    pairs = []
    for k in range(300):
        n, m = rng.integers(1, 200), rng.integers(1, 200)
        both = int(rng.integers(0, min(n, m) + 1))
        if k % 2:  # around the threshold
            m, both = n, n - int(rng.integers(0, n // 5 + 1))
        shared = rng.integers(0, 2 ** 63, both, dtype=np.uint64)
        x = np.unique(np.concatenate([shared, rng.integers(0, 2 ** 63, n - both, dtype=np.uint64)]))
        y = np.unique(np.concatenate([shared, rng.integers(0, 2 ** 63, m - both, dtype=np.uint64)]))
        c = len(np.intersect1d(x, y))
        pairs.append((len(x), nd.bitmap(x).tolist(), len(y), nd.bitmap(y).tolist(), bool(100 * c >= 80 * (len(x) + len(y) - c))))
    df = spark.createDataFrame(pairs, "n long, x array<long>, m long, y array<long>, linked boolean").withColumn("may", nd._may_link("n", "x", "m", "y", 80))
    rows = df.collect()
    assert all(r.may for r in rows if r.linked) and sum(r.linked for r in rows) > 50
    assert sum(r.may for r in rows if not r.linked) < 100
