import random

import numpy as np
import pytest

from vigil.llm import decontaminate as dc


def naive(p, t, least):
    """Greedy string tiling by trying all starts: tokens covered."""
    mp, mt, total = [False] * len(p), [False] * len(t), 0
    while True:
        best, found = least - 1, []
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not mp[i + k] and not mt[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= least:
                    found.append((i, j))
        if not found:
            return total
        for i, j in found:
            if not any(mp[i: i + best]) and not any(mt[j: j + best]):
                mp[i: i + best] = mt[j: j + best] = [True] * best
                total += best


@pytest.mark.parametrize("values", [2, 3, 6])
def test_tiling_matches_naive(values):
    r = random.Random(values)
    for _ in range(150):
        p, t = ([r.randrange(values) for _ in range(r.randint(0, n))] for n in (20, 35))
        assert sum(x[2] for x in dc.tile(np.array(p, np.uint64), np.array(t, np.uint64), 3)) == naive(p, t, 3)


ITEM = "The quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree"


def test_pairs(spark):
    w = ITEM.split()
    docs = [
        (1, f"before {ITEM} after"), (2, " ".join(w[9:] + ["gap"] + w[:9])), (3, ITEM.upper().replace(" ", ",\n")), (4, " ".join(w[:6]) + " and then nothing"),
        (5, None), (6, ""), (7, "some other text of no interest at all " * 400), (8, "pad " * 20000 + ITEM), (None, ITEM), (9, " ".join(w[:4])), (1, f"before {ITEM} after"),
    ]
    bench = [(10, ITEM), (11, ITEM), (12, "too short"), (13, None), (None, "an item without id but with enough words")]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int").repartition(3)
    b = spark.createDataFrame([(i, t, "z") for i, t in bench], "item_id long, text string, doc_id string")
    want = sorted(str((i, k)) for i in (1, 1, 2, 3, 8, None) for k in (10, 11))
    for block in (dc.BLOCK_BYTES, 1):
        got = dc.overlaps(d, b, block_bytes=block).collect()
        assert sorted(str((r.doc_id, r.item_id)) for r in got) == want
        assert all(r.coverage >= 0.5 and r.covered_tokens <= r.item_tokens for r in got)
        left = dc.clean(d, b, block_bytes=block)
        assert left.columns == d.columns
        assert sorted(r.doc_id for r in left.collect()) == [4, 5, 6, 7, 9]


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert dc.overlaps(d, b).count() == dc.overlaps(full, b).count() == dc.clean(d, b).count() == 0
    assert dc.clean(full, b).count() == 1
