"""Queries of this subpackage and their SQL, for the entry point."""

from __future__ import annotations

from leafmill.llm import classifier, html, langid, mixing, packing, quality, simhash, substring, tokens, vectors

QUERIES = {
    "op1_substring": substring.op1_substring,
    "op2_packing": packing.op2_packing,
    "op3_quality": quality.op3_quality,
    "op4_tokens": tokens.op4_tokens,
    "op5_simhash": simhash.op5_simhash,
    "op6_mixing": mixing.op6_mixing,
    "op7_html": html.op7_html,
    "op8_classifier": classifier.op8_classifier,
    "op9_vectors": vectors.op9_vectors,
    "op10_langid": langid.op10_langid,
}
ORACLE_SQL = {"op1_substring": substring.OP1_SQL, "op3_quality": quality.OP3_SQL, "op4_tokens": tokens.OP4_SQL, "op6_mixing": mixing.OP6_SQL, "op9_vectors": vectors.OP9_SQL}
