"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from heliolake.llm import (divergence, fingerprints, languages, mixing, ngram_join, packing, periodic, pii, search, secrets, sharding, substrings,
                           toxicity)

QUERIES = {
    "op1_hilbert_shards": sharding.op1_hilbert_shards,
    "op2_secret_ownership": secrets.op2_secret_ownership,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_disguised_pii": pii.op4_disguised_pii,
    "op5_repeated_windows": substrings.op5_repeated_windows,
    "op6_exact_top_k": search.op6_exact_top_k,
    "op7_merkle_fingerprints": fingerprints.op7_merkle_fingerprints,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_output_codes": languages.op11_output_codes,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLE_SQL = {
    "op5_repeated_windows": substrings.OP5_SQL,
    "op6_exact_top_k": search.OP6_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op9_ngram_join": ngram_join.OP9_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
