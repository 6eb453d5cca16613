"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from txrisk.llm import (
    conversations,
    decontamination,
    dual_tree,
    mixing,
    near_duplicates,
    packing,
    pii,
    quality_gam,
    rotated_codes,
    secrets,
    substrings,
    token_files,
    url_filter,
)

QUERIES = {
    "op1_rotated_codes": rotated_codes.rotated_codes,
    "op2_decontamination": decontamination.decontamination,
    "op3_quality_gam": quality_gam.quality_gam,
    "op4_pii": pii.pii,
    "op5_url_filter": url_filter.url_filter,
    "op6_substrings": substrings.substrings,
    "op7_packing": packing.packing,
    "op8_near_duplicates": near_duplicates.jaccard_join,
    "op9_secrets": secrets.secrets,
    "op10_token_files": token_files.token_files,
    "op11_conversation_repair": conversations.repaired_conversations,
    "op12_source_mixing": mixing.mixing,
    "op13_vector_codes": dual_tree.vector_codes,
}

SQL = {
    "op5_url_filter": url_filter.SQL,
    "op12_source_mixing": mixing.SQL,
    "op13_vector_codes": dual_tree.SQL,
}
