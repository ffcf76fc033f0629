"""Registered queries of the package, and their SQL where SQL can express them."""

from __future__ import annotations

from siftgate.llm import alignment, conversations, exact_dedup, language, mixing, packing, passages, secret_scan, sharding, simhash, suffixes, topk, toxicity

QUERIES = {
    "op1_secrets": secret_scan.op1_secrets,
    "op2_packing": packing.op2_packing,
    "op3_simhash": simhash.op3_simhash,
    "op4_sharding": sharding.op4_sharding,
    "op5_mixing": mixing.op5_mixing,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_passages": passages.op7_passages,
    "op8_suffixes": suffixes.op8_suffixes,
    "op9_topk": topk.op9_topk,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_language": language.op11_language,
    "op12_alignment": alignment.op12_alignment,
    "op13_conversations": conversations.op13_conversations,
}

SQL = {
    "op9_topk": topk.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
}
