"""Queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from hirelake.llm import (
    exact_dedup,
    fingerprint,
    html_extract,
    langid,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    pii,
    prefix_trie,
    quality,
    url_filter,
    variants,
)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_minmax_near_dedup": near_dedup.op3_minmax_near_dedup,
    "op4_language_id": langid.op4_language_id,
    "op5_html_extract": html_extract.op5_html_extract,
    "op6_systematic_mix": mixing.op6_systematic_mix,
    "op7_paragraph_sketch": fingerprint.op7_paragraph_sketch,
    "op8_pii": pii.op8_pii,
    "op9_quality_ranking": quality.op9_quality_ranking,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_url_filter": url_filter.op13_url_filter,
}

ORACLE = {
    "op2_exact_dedup": exact_dedup.ORACLE_SQL,
    "op6_systematic_mix": mixing.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op12_spelling_variants": variants.ORACLE_SQL,
    "op13_url_filter": url_filter.ORACLE_SQL,
}
