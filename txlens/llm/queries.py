"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from txlens.llm import (
    decontamination,
    exact_dedup,
    filter_audit,
    fingerprints,
    hard_negatives,
    language_id,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    substring_dedup,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_filter_urls": url_filter.op3_filter_urls,
    "op4_decontaminate": decontamination.op4_decontaminate,
    "op5_language_id": language_id.op5_language_id,
    "op6_quality": quality.op6_quality,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}
ORACLES = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_substring_dedup": substring_dedup.SQL,
    "op3_filter_urls": url_filter.SQL,
    "op9_mix_sources": mixing.SQL,
    "op10_near_dedup": near_dedup.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
