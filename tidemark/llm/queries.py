"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from tidemark.llm import exact_dedup, fill_in_middle, license_scan, media_columns, packing, prefix_trie, quality, secret_scan, simhash, source_mix, substring_dedup, toxicity, url_filter

QUERIES = {
    "op1_source_mix": source_mix.op1_source_mix,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_media_columns": media_columns.op4_media_columns,
    "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_packing": packing.op10_packing,
    "op11_license_scan": license_scan.op11_license_scan,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE_SQL = {
    "op1_source_mix": source_mix.OP1_SQL,
    "op2_substring_dedup": substring_dedup.OP2_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op9_url_filter": url_filter.OP9_SQL,
    "op12_fill_in_middle": fill_in_middle.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
