"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from dockcast.llm import (chat, decontaminate, filteraudit, fingerprint, html, linededup, merkle, mixing, neardup, oracles, quality,
                          sharding, simhash, substring)
from dockcast.llm.common import table

QUERIES = {
    "op1_decontamination": lambda spark, sf: decontaminate.decontaminate_query(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op2_quality": lambda spark, sf: quality.quality_query(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op3_line_dedup": lambda spark, sf: linededup.line_rows(table(spark, sf, "documents")),
    "op4_fingerprints": lambda spark, sf: fingerprint.fingerprint_query(table(spark, sf, "documents")),
    "op5_near_duplicates": lambda spark, sf: neardup.neardup_query(table(spark, sf, "documents")),
    "op6_mixing": lambda spark, sf: mixing.mix_query(table(spark, sf, "documents")),
    "op7_chat_format": lambda spark, sf: chat.chat_query(table(spark, sf, "conversations")),
    "op8_sharding": lambda spark, sf: sharding.shard_query(table(spark, sf, "documents")),
    "op9_substring_dedup": lambda spark, sf: substring.substring_query(table(spark, sf, "documents")),
    "op10_html_text": lambda spark, sf: html.html_query(table(spark, sf, "pages")),
    "op11_filter_audit": lambda spark, sf: filteraudit.audit_query(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op12_merkle_manifest": lambda spark, sf: merkle.merkle_query(table(spark, sf, "documents")),
    "op13_simhash": lambda spark, sf: simhash.simhash_query(table(spark, sf, "documents")),
}

ORACLE = {
    "op1_decontamination": oracles.CONTAMINATION,
    "op5_near_duplicates": oracles.NEAR_DUPLICATES,
    "op6_mixing": mixing.MIX_SQL,
    "op7_chat_format": chat.CHAT_SQL,
    "op9_substring_dedup": oracles.REPEATED_WINDOWS,
    "op11_filter_audit": filteraudit.AUDIT_SQL,
    "op12_merkle_manifest": merkle.MERKLE_SQL,
}
