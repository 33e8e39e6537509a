"""The queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from . import ann, exact_dedup, license_scan, mixing, near_dup, packing, recurrent_lm, substring_dedup, token_store, toxicity


def queries() -> dict:
    return {
        "op1_nearest_neighbours": ann.op1_nearest_neighbours,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_recurrent_lm": recurrent_lm.op3_recurrent_lm,
        "op4_mixing": mixing.op4_mixing,
        "op5_token_store": token_store.op5_token_store,
        "op6_license_scan": license_scan.op6_license_scan,
        "op7_ngram_jaccard_join": near_dup.op7_ngram_jaccard_join,
        "op8_substring_dedup": substring_dedup.op8_substring_dedup,
        "op9_best_fit_packing": packing.op9_best_fit_packing,
        "op10_toxicity": toxicity.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": exact_dedup.SQL,
        "op6_license_scan": license_scan.oracle(),
        "op7_ngram_jaccard_join": near_dup.SQL,
        "op8_substring_dedup": substring_dedup.SQL,
    }
