"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from tidemark.llm import exact_topk, fingerprints, language_id, license_scan, lm_scoring, mixing, ngram_join, packing, token_counts, url_filters

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_url_filters": url_filters.op3_url_filters,
    "op4_mixing": mixing.op4_mixing,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_license_scans": license_scan.op6_license_scans,
    "op7_lm_scoring": lm_scoring.op7_lm_scoring,
    "op8_packing": packing.op8_packing,
    "op9_exact_topk": exact_topk.op9_exact_topk,
    "op10_fingerprints": fingerprints.op10_fingerprints,
}

ORACLE = {
    "op2_ngram_join": ngram_join.OP2_SQL,
    "op3_url_filters": url_filters.OP3_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op9_exact_topk": exact_topk.OP9_SQL,
}
