import hashlib
import re

import corpus_pipeline
from vigil.llm import bpe, decontaminate, quality
from tests_llm_helpers import components_of, tiles_cover

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).collect() if r.predicted}
    first = {}
    for i in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i]), i)
    unique = sorted(first.values())
    reps = components_of({i: rows[i] for i in unique}, 80)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = sorted(i for i in reps if not any(tiles_cover(rows[i], t, decontaminate.MIN_MATCH, decontaminate.COVERAGE) for t in items))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == want
    c = bpe.codec()
    assert all(c.decode(r.ids) == rows[r.doc_id].encode() and r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_last_stage_decodes(spark):
    docs = spark.createDataFrame([(1, "a b \u00e9\U0001f600"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    for i, t in ((1, "a b \u00e9\U0001f600"), (2, ""), (3, "")):
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
