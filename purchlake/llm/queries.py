"""The queries of this subpackage: name -> (callable, DuckDB SQL or None)."""

from __future__ import annotations

from . import (byte_bpe, content_sort_dedup, divergence_audit, genetic_packing, language_bits, license_rules, ngram_join,
               pii_anchors, reshard, small_world, spelling_variants, suffix_dedup, temperature_mixing)

QUERIES = {
    "op1_genetic_packing": (genetic_packing.query, None),
    "op2_license_rules": (license_rules.query, None),
    "op3_temperature_mixing": (temperature_mixing.query, None),
    "op4_suffix_dedup": (suffix_dedup.query, suffix_dedup.SQL),
    "op5_ngram_jaccard_join": (ngram_join.query, ngram_join.SQL),
    "op6_language_bits": (language_bits.query, None),
    "op7_pii_anchors": (pii_anchors.query, None),
    "op8_min_cost_reshard": (reshard.query, None),
    "op9_small_world": (small_world.query, small_world.SQL),
    "op10_content_sort_dedup": (content_sort_dedup.query, content_sort_dedup.SQL),
    "op11_byte_bpe": (byte_bpe.query, None),
    "op12_pivotal_grams": (spelling_variants.query, spelling_variants.SQL),
    "op13_run_length_audit": (divergence_audit.query, divergence_audit.SQL),
}
