"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from medcohort.llm import (conversation_repair, decontamination, embedding_dedup, hard_negatives, html_extraction, line_dedup,
                           ngram_join, packing, quality, sharding, substring_dedup, toxicity, url_filters)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_benchmark_decontamination": decontamination.op5_benchmark_decontamination,
    "op6_embedding_near_dedup": embedding_dedup.op6_embedding_near_dedup,
    "op7_html_extraction": html_extraction.op7_html_extraction,
    "op8_sharding": sharding.op8_sharding,
    "op9_url_filters": url_filters.op9_url_filters,
    "op10_ngram_jaccard_join": ngram_join.op10_ngram_jaccard_join,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_quality": quality.op12_quality,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

ORACLES = {
    "op3_substring_dedup": substring_dedup.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op5_benchmark_decontamination": decontamination.ORACLE,
    "op9_url_filters": url_filters.ORACLE,
    "op10_ngram_jaccard_join": ngram_join.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
