"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from tagtide.llm import (
    alignment,
    bpe,
    chats,
    epsilon_grid,
    exact_dedup,
    hyperminhash,
    language_model,
    mixing,
    packing,
    quality,
    sharding,
    substring_dedup,
    whitening,
)

QUERIES = {
    f.__name__: f
    for f in (
        exact_dedup.op1_exact_dedup,
        sharding.op2_sharding,
        language_model.op3_lm_scoring,
        bpe.op4_byte_bpe,
        mixing.op5_mixing,
        substring_dedup.op6_substring_dedup,
        quality.op7_quality,
        epsilon_grid.op8_embedding_dedup,
        hyperminhash.op9_minhash_dedup,
        chats.op10_chat_formatting,
        alignment.op11_alignment,
        whitening.op12_whitening,
        packing.op13_packing,
    )
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op6_substring_dedup": substring_dedup.OP6_SQL,
    "op8_embedding_dedup": epsilon_grid.OP8_SQL,
    "op9_minhash_dedup": hyperminhash.OP9_SQL,
    "op10_chat_formatting": chats.OP10_SQL,
}
