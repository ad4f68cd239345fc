"""Registered queries of the text operators and their SQL counterparts."""

from __future__ import annotations

from fleetlake.llm import (
    classifier,
    conversations,
    exact_dup,
    fingerprints,
    licenses,
    line_dedup,
    mixing,
    near_dup,
    pieces,
    pii,
    quality_rules,
    spelling,
    warc,
)

QUERIES = {
    "op1_source_mixing": mixing.op1_query,
    "op2_pii": pii.op2_query,
    "op3_line_dedup": line_dedup.op3_query,
    "op4_fingerprints": fingerprints.op4_query,
    "op5_quality_rules": quality_rules.op5_query,
    "op6_dart_minhash": near_dup.op6_query,
    "op7_ordinal_classifier": classifier.op7_query,
    "op8_license_scan": licenses.op8_query,
    "op9_warc_salvage": warc.op9_query,
    "op10_sentencepiece": pieces.op10_query,
    "op11_exact_dedup": exact_dup.op11_query,
    "op12_spelling_variants": spelling.op12_query,
    "op13_conversation_repair": conversations.op13_query,
}

SQL = {
    "op1_source_mixing": mixing.OP1_SQL,
    "op3_line_dedup": line_dedup.OP3_SQL,
    "op5_quality_rules": quality_rules.OP5_SQL,
    "op8_license_scan": licenses.OP8_SQL,
    "op9_warc_salvage": warc.OP9_SQL,
    "op11_exact_dedup": exact_dup.OP11_SQL,
    "op12_spelling_variants": spelling.OP12_SQL,
    "op13_conversation_repair": conversations.OP13_SQL,
}
