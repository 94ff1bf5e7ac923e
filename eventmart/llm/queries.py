"""Registered queries of the training-data operators."""

from __future__ import annotations

from eventmart.llm import decontaminate, exact_dedup, html_extraction, jaccard_join, lexical_search, license_scan, line_dedup, mixing, pipeline, quality, substring_dedup, token_output, toxicity, whitening

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_token_output": token_output.op3_token_output,
    "op4_quality": quality.op4_quality,
    "op5_mixing": mixing.op5_mixing,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op7_passage_dedup": line_dedup.op7_passage_dedup,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_html_extraction": html_extraction.op11_html_extraction,
    "op12_whitening": whitening.op12_whitening,
    "op13_lexical_search": lexical_search.op13_lexical_search,
    "pipeline": pipeline.run,
}
ORACLES = {
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}
