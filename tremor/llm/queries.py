"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tremor.llm import (
    chat,
    decontaminate,
    imatch,
    jaccard_join,
    line_dedup,
    packing,
    prefix_trie,
    resample,
    substring_dedup,
    suffix_dedup,
    token_files,
    toxicity,
    urls,
)

QUERIES = {
    "op1_token_files": token_files.op1_token_files,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_imatch": imatch.op5_imatch,
    "op6_packing": packing.op6_packing,
    "op7_url_filter": urls.op7_url_filter,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_chat_format": chat.op10_chat_format,
    "op11_importance_resampling": resample.op11_importance_resampling,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLES = {
    "op8_substring_dedup": substring_dedup.ORACLE_SQL,
    "op9_jaccard_join": jaccard_join.ORACLE_SQL,
    "op7_url_filter": urls.ORACLE_SQL,
    "op10_chat_format": chat.ORACLE_SQL,
    "op11_importance_resampling": resample.ORACLE_SQL,
    "op12_line_dedup": line_dedup.ORACLE_SQL,
    "op13_prefix_trie": prefix_trie.ORACLE_SQL,
}
