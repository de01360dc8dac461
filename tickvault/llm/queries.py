"""The queries of this package, by the names under which they are registered, and their SQL where it has the same rows."""

from __future__ import annotations

from tickvault.llm import bpe, chat, fingerprint, html, idfile, jaccard, lm, packing, quality, substring

QUERIES = {
    "op1_fingerprint": fingerprint.op1_fingerprint,
    "op2_substring_dedup": substring.op2_substring_dedup,
    "op3_bpe_trie": bpe.op3_bpe_trie,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_html": html.op5_html,
    "op6_packing": packing.op6_packing,
    "op7_chat": chat.op7_chat,
    "op8_lm_scores": lm.op8_lm_scores,
    "op9_id_files": idfile.op9_id_files,
    "op10_ngram_jaccard": jaccard.op10_ngram_jaccard,
}

SQL = {
    "op4_quality_rules": quality.OP4_SQL,
    "op7_chat": chat.OP7_SQL,
}
