"""The Merkle manifest against a plain recursive build."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from vigil.llm import merkle as M


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    out = ""
    for v in row:
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def tree(hashes):
    """(root, path of (left, right) of each leaf)."""
    paths, at, now = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(now) > 1:
        for k, i in enumerate(at):
            first = i - i % 8
            paths[k].append(("".join(now[first:i]), "".join(now[i + 1: first + 8])))
            at[k] = i // 8
        now = [sha("".join(now[i: i + 8])) for i in range(0, len(now), 8)]
    return now[0], paths


def brute(rows):
    """Sorted results of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, over = tree([built[g][0] for g in names])
    out = []
    for g, above in zip(names, over):
        for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), built[g][1]):
            r = x[3]
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now, proof = leaf((*r[:4], text)), ""
            for a, b in path + above:
                now, proof = sha(a + now + b), proof + a + b
            out.append((r[0], x[2], built[g][0], root, sha(proof), now, now == root))
    return sorted(out, key=str)


def rows_of(n, lang):
    return [(k * 7 % 1009, f"s{k % 3}", lang, k if k % 5 else None, None if k % 11 == 0 else f"Some TEXT Éa {k}" if k % 4 else f"lower {k}") for k in range(n)]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
CASES = {
    "one": rows_of(1, "en"),
    "eight and nine": rows_of(8, "a") + rows_of(9, "b") + rows_of(1, ""),
    "levels": rows_of(700, "en") + rows_of(65, None) + rows_of(64, "é") + rows_of(1, "z"),
    "many groups": [(k, "s", f"g{k % 75}", 1, "T") for k in range(200)],
    "repeats": [(1, "s", "en", 1, "Text")] * 30 + [(1, "s", "en", 1, "Other")] * 20 + [(None, None, None, None, None)] * 9 + [(None, "s", "en", 1, "X")] * 3,
}


@pytest.mark.parametrize("name", CASES)
def test_equals_plain_build(spark, tmp_path, name):
    spark.createDataFrame(CASES[name], SCHEMA).withColumns({c: F.lit("clash") for c in ("tree", "hash", "idx", "path", "key")}).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in M.op13_merkle(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == brute(CASES[name])


def test_empty_table(spark):
    assert M.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_paths_prove_membership(spark):
    docs = spark.createDataFrame(rows_of(90, "en") + rows_of(5, "fr"), SCHEMA)
    rows = M.manifest(docs)
    bad = rows.where(M.fold(F.col("path"), F.col("leaf")) != F.col("root"))
    assert bad.count() == 0 and rows.select("root").distinct().count() == 1
    # another fan-out is another tree with proofs of its own
    two = M.manifest(docs, fanout=2)
    assert two.where(M.fold(F.col("path"), F.col("leaf")) == F.col("root")).count() == 95


def test_changed_rows_are_found(spark):
    docs = spark.createDataFrame(rows_of(90, "en"), SCHEMA)
    changed = F.when(F.col("doc_id") == 7, F.lit("forged")).otherwise(F.col("text"))
    rows = M.manifest(docs, probe=M.leaf_hash([changed if f == "text" else F.col(f) for f in M.FIELDS]))
    assert [r.key for r in rows.where("folded != root").collect()] == [7]
