"""The queries of this folder and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

from attesta.llm import chat_format, decontaminate, exact_dedup, jaccard_join, language_id, main_text, quality_rules, secrets, sentencepieces, suffix_dedup

QUERIES = {
    "op1_main_text": main_text.query,
    "op2_sentencepiece": sentencepieces.query,
    "op3_suffix_dedup": suffix_dedup.query,
    "op4_secrets": secrets.query,
    "op5_jaccard_join": jaccard_join.query,
    "op6_decontaminate": decontaminate.query,
    "op7_quality_rules": quality_rules.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_chat_format": chat_format.query,
    "op10_language_id": language_id.query,
}
ORACLE_SQL = {
    "op1_main_text": main_text.SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op9_chat_format": chat_format.SQL,
}
