"""Queries of this folder and their SQL."""

from __future__ import annotations

from crmtide.llm import (
    embedding_dedup,
    fim,
    hard_negatives,
    hmm,
    mixing,
    near_dedup,
    packing,
    sharding,
    substring_dedup,
    suffix_dedup,
    topk,
    toxicity,
    warc,
)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
    "op3_packing": packing.op3_packing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_hmm": hmm.op6_hmm,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_mixing": mixing.op8_mixing,
    "op9_warc": warc.op9_warc,
    "op10_topk": topk.op10_topk,
    "op11_suffix_dedup": suffix_dedup.op11_suffix_dedup,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_fim": fim.op13_fim,
}

ORACLE = {
    "op1_sharding": sharding.ORACLE,
    "op2_embedding_dedup": embedding_dedup.ORACLE,
    "op7_near_dedup": near_dedup.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_topk": topk.ORACLE,
    "op11_suffix_dedup": suffix_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_fim": fim.ORACLE,
}
