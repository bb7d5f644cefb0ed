"""Queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from lakelens.llm import byte_bpe, chat_collapse, exact_dedup, hard_negatives, ngram_join, packing, secret_scan, sharding, substring_dedup, topk_search, toxicity, url_filter, whitening

QUERIES = {
    "op1_chat_collapse": chat_collapse.op1_chat_collapse,
    "op2_byte_bpe": byte_bpe.op2_byte_bpe,
    "op3_sharding": sharding.op3_sharding,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_topk_search": topk_search.op7_topk_search,
    "op8_packing": packing.op8_packing,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_whitening": whitening.op12_whitening,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
}
ORACLES = {
    "op1_chat_collapse": chat_collapse.OP1_SQL,
    "op4_secret_scan": secret_scan.OP4_SQL,
    "op7_topk_search": topk_search.OP7_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "op10_url_filter": url_filter.OP10_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op13_substring_dedup": substring_dedup.OP13_SQL,
}
