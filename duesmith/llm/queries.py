"""The registered queries of this subpackage and, where SQL can express them, their DuckDB checks."""

from __future__ import annotations

from duesmith.llm import (
    decontamination,
    exact_dedup,
    packing,
    personal_data,
    phrases,
    quality,
    secret_scan,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
    vector_codes,
    warc,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_packing": packing.op3_packing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_simhash": simhash.op5_simhash,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_secrets": secret_scan.op8_secrets,
    "op9_personal_data": personal_data.op9_personal_data,
    "op10_warc": warc.op10_warc,
    "op11_phrases": phrases.op11_phrases,
    "op12_quality": quality.op12_quality,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

CHECKS: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.OP1_CHECK,
    "op6_substring_dedup": substring_dedup.OP6_CHECK,
    "op10_warc": warc.OP10_CHECK,
    "op11_phrases": phrases.OP11_CHECK,
    "op13_vector_codes": vector_codes.OP13_CHECK,
}
