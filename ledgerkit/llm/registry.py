"""The registered queries of this subpackage and their DuckDB SQL."""
from __future__ import annotations

from . import (chat, decontamination, embedding_dedup, mixing, neardup, pii, prefix_trie, quality_model, quality_rules, secrets,
               sharding, toxicity, vector_codes)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_chat_formatting": chat.op2_chat_formatting,
    "op3_sharding": sharding.op3_sharding,
    "op4_pii_surrogates": pii.op4_pii_surrogates,
    "op5_near_duplicates": neardup.op5_near_duplicates,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_quality_model": quality_model.op7_quality_model,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_embedding_dedup": embedding_dedup.op11_embedding_dedup,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}
ORACLE_SQL = {"op1_mixing": mixing.ORACLE, "op2_chat_formatting": chat.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE,
              "op13_vector_codes": vector_codes.ORACLE}
