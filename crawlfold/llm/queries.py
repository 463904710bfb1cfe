"""Registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from crawlfold.llm import (
    bisector_clusters, context_tree, decontaminate, dimension_scan, hilbert_shards, jaccard_join, line_dedup, main_text,
    phrase_dedup, quality_rules, radix_dedup, sentencepiece_sampling, token_alignment,
)

QUERIES = {
    "op1_sentencepiece_sampling": sentencepiece_sampling.op1_sentencepiece_sampling,
    "op2_hilbert_shards": hilbert_shards.op2_hilbert_shards,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_radix_dedup": radix_dedup.op4_radix_dedup,
    "op5_phrase_dedup": phrase_dedup.op5_phrase_dedup,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_context_tree": context_tree.op7_context_tree,
    "op8_main_text": main_text.op8_main_text,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_dimension_scan": dimension_scan.op11_dimension_scan,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_bisector_clusters": bisector_clusters.op13_bisector_clusters,
}
SQL = {
    "op3_decontaminate": decontaminate.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op13_bisector_clusters": bisector_clusters.SQL,
}
