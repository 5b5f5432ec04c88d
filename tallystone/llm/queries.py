"""The training-data queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import attention_lm, chat_format, decontaminate, jaccard_forest, language_id, line_dedup, media, sp_lattice, suffix_dedup, token_counts

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_chat_windows": chat_format.query,
    "op3_token_counts": token_counts.query,
    "op4_language_id": language_id.query,
    "op5_sentencepiece": sp_lattice.query,
    "op6_suffix_dedup": suffix_dedup.query,
    "op7_decontaminate": decontaminate.query,
    "op8_jaccard_forest": jaccard_forest.query,
    "op9_attention_lm": attention_lm.query,
    "op10_wav_fingerprints": media.query,
}
ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_chat_windows": chat_format.ORACLE,
    "op7_decontaminate": decontaminate.ORACLE,
}
