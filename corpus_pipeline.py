"""Corpus pipeline: from raw documents to token ids.

Five stages, each a (name, function) pair in ``STAGES``; a function takes
(spark, docs, sf_dir) and returns a DataFrame. The result of a stage is written
as Parquet into the shared folder that the session names in
``spark.checkpoint.dir`` and read again as the next one's input, so a lost
executor costs at most one stage. All stages but the last return the columns of
``documents``; the last returns doc_id, n_tokens, ids
and decoded_sha256 (of the bytes that the ids decode to).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from vigil.session import ensure_checkpoint_dir

STAGES = [
    ("quality classifier", quality.stage),
    ("exact dedup", exact_dedup.stage),
    ("minhash near-dedup", near_dedup.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("byte-level bpe", bpe.stage),
]

#: Models, similarity search on hashed signatures, tilings and merges are beyond SQL: tests compare with a brute-force run instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
