"""The registered queries of this subpackage, and their SQL oracles."""

from __future__ import annotations

from tidemark.llm import (clusters, decontaminate, fingerprints, language_model, mixing, near_duplicates, pii, quality, secrets, shards,
                          spelling, tokens, toxicity)

QUERIES = {
    "op1_blob_ledger_secrets": secrets.op1_blob_ledger_secrets,
    "op2_curriculum_mix": mixing.op2_curriculum_mix,
    "op3_bottom_k_near_duplicates": near_duplicates.op3_bottom_k_near_duplicates,
    "op4_offset_mapped_tokens": tokens.op4_offset_mapped_tokens,
    "op5_pigeonhole_leaks": decontaminate.op5_pigeonhole_leaks,
    "op6_boosted_tree_quality": quality.op6_boosted_tree_quality,
    "op7_subsequence_kernel_toxicity": toxicity.op7_subsequence_kernel_toxicity,
    "op8_i_match_fingerprints": fingerprints.op8_i_match_fingerprints,
    "op9_hash_tree_shards": shards.op9_hash_tree_shards,
    "op10_partial_matching_scores": language_model.op10_partial_matching_scores,
    "op11_subvector_clusters": clusters.op11_subvector_clusters,
    "op12_offset_preserving_pii": pii.op12_offset_preserving_pii,
    "op13_sorted_list_spellings": spelling.op13_sorted_list_spellings,
}
ORACLE_SQL = {
    "op2_curriculum_mix": mixing.OP2_SQL,
    "op11_subvector_clusters": clusters.OP11_SQL,
}
