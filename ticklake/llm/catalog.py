"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from ticklake.llm import (decontaminate, exact_dedup, jaccard_join, language_id, mixing, pii, reply_trees, secret_scan,
                          substring_dedup, suffix_array, token_alignment, url_filter, whitening)

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_suffix_array_dedup": suffix_array.op5_suffix_array_dedup,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_pii": pii.op7_pii,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_language_id": language_id.op9_language_id,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_chat_format": reply_trees.op11_chat_format,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}
#: op12 (eigenvectors) and op13 (tokenizers) have none; their tests compare with
#: dense eigenvectors and with plain loops over every byte.
#: op9 has none: a trained model is not SQL; its test measures held-out accuracy.
#: op2 (components) and op5 (all windows of 400 bytes) are too slow in SQL on whole
#: tables; their tests compare with brute force.
#: op3 and op7 have none: their hashes (xxhash64, Feistel rounds) have no twin in
#: DuckDB; their tests compare with brute force and check the permutations.
ORACLE_SQL = {
    "op1_secret_scan": secret_scan.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op6_url_filter": url_filter.ORACLE,
    "op8_mix_sources": mixing.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_chat_format": reply_trees.ORACLE,
}
