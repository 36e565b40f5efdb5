"""Registered queries of the operators, and SQL where SQL can express them."""

from __future__ import annotations

from ledgerline.llm import (
    bpe,
    collocations,
    fingerprints,
    importance,
    line_dedup,
    mixing,
    ngram_join,
    packages,
    sharding,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
)

QUERIES = {
    "op1_fingerprint_documents": fingerprints.op1_fingerprint_documents,
    "op2_shard_documents": sharding.op2_shard_documents,
    "op3_pages_round_trip": packages.op3_pages_round_trip,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_bpe_round_trip": bpe.op5_bpe_round_trip,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_top_k": topk.op9_top_k,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_importance_resampling": importance.op11_importance_resampling,
    "op12_collocations": collocations.op12_collocations,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
}

SQL = {
    "op3_pages_round_trip": packages.OP3_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op9_top_k": topk.OP9_SQL,
    "op11_importance_resampling": importance.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_suffix_dedup": suffix_dedup.OP13_SQL,
}
