"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from vigil.llm.bpe import op8_bpe
from vigil.llm.decontaminate import op10_decontaminate
from vigil.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from vigil.llm.html_text import op4_html_text
from vigil.llm.merkle import OP13_SQL, op13_merkle
from vigil.llm.near_dedup import op7_near_dedup
from vigil.llm.ngram_lm import OP3_SQL, OP3_WHOLE_SQL, op3_ngram_lm, op3_ngram_lm_whole
from vigil.llm.packing import op11_packing
from vigil.llm.quality import op1_quality
from vigil.llm.runs import op12_runs
from vigil.llm.secrets import op9_secrets
from vigil.llm.sharding import op2_sharding
from vigil.llm.token_counts import op6_token_counts

QUERIES = {
    "op1_quality": op1_quality,
    "op2_sharding": op2_sharding,
    "op3_ngram_lm": op3_ngram_lm,
    "op3_ngram_lm_whole": op3_ngram_lm_whole,
    "op4_html_text": op4_html_text,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_near_dedup": op7_near_dedup,
    "op8_bpe": op8_bpe,
    "op9_secrets": op9_secrets,
    "op10_decontaminate": op10_decontaminate,
    "op11_packing": op11_packing,
    "op12_runs": op12_runs,
    "op13_merkle": op13_merkle,
}

ORACLE: dict[str, str] = {
    "op3_ngram_lm": OP3_SQL,
    "op3_ngram_lm_whole": OP3_WHOLE_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op13_merkle": OP13_SQL,
}
