"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from binyard.llm import (
    chat_format, decontaminate, hard_negatives, html_text, lang_id, line_dedup, lm_score, mixing, near_dedup, piece_encode, quality, url_filter, vector_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hyperminhash_near_dedup": near_dedup.op1,
        "op2_elias_fano_lm_score": lm_score.op2,
        "op3_prefix_target_chat": chat_format.op3,
        "op4_hash_threshold_mix": mixing.op4,
        "op5_bayes_language_id": lang_id.op5,
        "op6_minhash_containment": decontaminate.op6,
        "op7_quality_rules": quality.op7,
        "op8_min_cut_html": html_text.op8,
        "op9_site_spread_line_dedup": line_dedup.op9,
        "op10_blocked_bloom_urls": url_filter.op10,
        "op11_offset_preserving_pieces": piece_encode.op11,
        "op12_hilbert_hard_negatives": hard_negatives.op12,
        "op13_adaptive_bounds_codes": vector_codes.op13,
    }


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL can express; the others are tested against
    brute force, exact round trips or held-out accuracy."""
    return {
        "op1_hyperminhash_near_dedup": near_dedup.ORACLE,
        "op3_prefix_target_chat": chat_format.ORACLE,
        "op6_minhash_containment": decontaminate.ORACLE,
        "op9_site_spread_line_dedup": line_dedup.ORACLE,
        "op10_blocked_bloom_urls": url_filter.ORACLE,
        "op12_hilbert_hard_negatives": hard_negatives.ORACLE,
    }
