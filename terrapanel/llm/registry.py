"""The queries of this subpackage, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_automaton, collocations, decontamination, exact_dedup, language_id, line_rules, lm_scoring, ngram_join, quality_classifier, substring_dedup, token_counts, token_store, vector_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": token_counts.query,
        "op2_bpe_codec": bpe_automaton.query,
        "op3_ngram_jaccard_join": ngram_join.query,
        "op4_token_store": token_store.query,
        "op5_quality_classifier": quality_classifier.query,
        "op6_substring_dedup": substring_dedup.query,
        "op7_line_rules": line_rules.query,
        "op8_decontamination": decontamination.query,
        "op9_language_id": language_id.query,
        "op10_lm_scoring": lm_scoring.query,
        "op11_ball_codes": vector_codes.query,
        "op12_collocations": collocations.query,
        "op13_exact_dedup": exact_dedup.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_ball_codes": vector_codes.SQL, "op12_collocations": collocations.SQL, "op13_exact_dedup": exact_dedup.SQL}
