"""Queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from skyledger.llm import byte_bpe, decontamination, exact_dedup, html_text, jaccard_join, language, lm_scoring, mixing, quality, sharding, token_files, vector_codes

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_language_id": language.op6_language_id,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_html_text": html_text.op8_html_text,
    "op9_token_files": token_files.op9_token_files,
    "op10_sharding": sharding.op10_sharding,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_decontamination": decontamination.op12_decontamination,
}

ORACLES = {
    "op3_quality_rules": quality.op3_sql(),
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op10_sharding": sharding.op10_sql(),
    "op12_decontamination": decontamination.OP12_SQL,
}
