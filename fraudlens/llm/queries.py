"""Queries of this package: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from fraudlens.llm import (
    op1_token_counts,
    op2_decontaminate,
    op3_bpe_codec,
    op4_html_text,
    op5_embedding_dedup,
    op6_toxicity,
    op7_chat_format,
    op8_language_id,
    op9_bitplane_store,
    op10_jaccard_join,
    op11_spelling_variants,
    op12_token_alignment,
    op13_sequence_packing,
)

QUERIES = {
    "op1_token_counts": op1_token_counts.query,
    "op2_decontaminate": op2_decontaminate.query,
    "op3_bpe_codec": op3_bpe_codec.query,
    "op4_html_text": op4_html_text.query,
    "op5_embedding_dedup": op5_embedding_dedup.query,
    "op6_toxicity": op6_toxicity.query,
    "op7_chat_format": op7_chat_format.query,
    "op8_language_id": op8_language_id.query,
    "op9_bitplane_store": op9_bitplane_store.query,
    "op10_jaccard_join": op10_jaccard_join.query,
    "op11_spelling_variants": op11_spelling_variants.query,
    "op12_token_alignment": op12_token_alignment.query,
    "op13_sequence_packing": op13_sequence_packing.query,
}
ORACLE: dict[str, str] = {
    "op2_decontaminate": op2_decontaminate.ORACLE,
    "op5_embedding_dedup": op5_embedding_dedup.ORACLE,
    "op10_jaccard_join": op10_jaccard_join.ORACLE,
}
