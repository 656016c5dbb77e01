"""The queries ``opN_<name>`` of this subpackage and the SQL that checks them."""

from __future__ import annotations

from blockweave.llm import decontaminate, exact_dedup, html_extract, jaccard_join, mixing, quality, suffix_dedup, token_count, toxicity, url_filter

QUERIES = {
    "op1_html_extraction": html_extract.op1_html_extraction,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_mixing": mixing.op3_mixing,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_url_filters": url_filter.op5_url_filters,
    "op6_ngram_jaccard_join": jaccard_join.op6_ngram_jaccard_join,
    "op7_token_counts": token_count.op7_token_counts,
    "op8_benchmark_decontamination": decontaminate.op8_benchmark_decontamination,
    "op9_suffix_array_dedup": suffix_dedup.op9_suffix_array_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
}

ORACLE_SQL = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op3_mixing": mixing.SQL,
    "op5_url_filters": url_filter.SQL,
    "op6_ngram_jaccard_join": jaccard_join.SQL,
    "op8_benchmark_decontamination": decontaminate.SQL,
}
