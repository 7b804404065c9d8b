"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from airgrid.llm import (
    align_tokens,
    decontaminate,
    fill_in_middle,
    jaccard_join,
    mixing,
    piecewise_hash,
    quality_classifier,
    quality_rules,
    secrets,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filters,
)

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_mix": mixing.op8_mix,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_align_tokens": align_tokens.op12_align_tokens,
    "op13_fingerprints": piecewise_hash.op13_fingerprints,
}

SQL = {
    "op1_url_filters": url_filters.OP1_SQL,
    "op2_jaccard_join": jaccard_join.OP2_SQL,
    "op3_substring_dedup": substring_dedup.OP3_SQL,
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op8_mix": mixing.OP8_SQL,
    "op11_fill_in_middle": fill_in_middle.OP11_SQL,
}
