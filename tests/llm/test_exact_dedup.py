import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import fuse
from vigil.llm.exact_dedup import dedup, distinct_texts

ROWS = [
    (5, "a  b\tc", "x"), (3, "a b c", "x"), (9, "a\nb\x0bc", None), (1, "other", "x"), (2, None, "x"), (7, "", None),
    (4, " a b c", "x"), (None, "a b c", "x"), (None, "only null", "x"), (8, "x" * 50000, "x"), (6, "x" * 50000, "x"),
    (11, "same", "x"), (11, "same", "x"), (12, "same ", "x"), (13, "Same", "x"),
]
SCHEMA = "doc_id long, text string, kept string"


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows]
    out = []
    for (i, _, _), n in zip(rows, norm):
        ids = [r[0] for r, m in zip(rows, norm) if m == n]
        known = [x for x in ids if x is not None]
        out.append((i, min(known) if known else None, len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest_bytes", [32, 1])
@pytest.mark.parametrize("side", ["mixed", "all new", "all old"])
def test_dedup_matches_brute_force(spark, digest_bytes, side):
    rows = ROWS + [(100 + k, f"text {k % 40}", "x") for k in range(120)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    incoming = {"mixed": F.col("doc_id") % 2 == 1, "all new": F.lit(True), "all old": F.lit(False)}[side]
    got = dedup(df, incoming, digest_bytes=digest_bytes).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows)
    shas = {}
    for r in got:
        shas.setdefault(r.text_sha256, []).append(r.kept)
    assert all(sum(v) == 1 for v in shas.values())
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_stage_keeps_one_row_and_all_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = distinct_texts(df, F.col("doc_id") % 2 == 0)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(map(str, [3, 1, 2, 4, None, 6, 11, 12, 13]))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dedup(df, F.lit(True)).count() == 0
    assert distinct_texts(df).count() == 0


def test_filters_have_no_false_negatives():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 17, 500, 9000):
        keys = rng.integers(0, 2**63, n).astype(np.uint64)
        f = fuse.build(np.concatenate([keys, keys]))
        assert fuse.contains(f, keys).all()
        assert fuse.contains(f, rng.integers(0, 2**63, 20000).astype(np.uint64)).mean() < 0.01
