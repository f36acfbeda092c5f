"""Queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from . import bpe_codec, ctph, exact_dedup, langid, mixing, ngram_join, packing, quality, sharding, spelling, token_counts, toxicity, vector_codes

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_sharding": sharding.op2_sharding,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_fingerprints": ctph.op4_fingerprints,
    "op5_language": langid.op5_language,
    "op6_quality": quality.op6_quality,
    "op7_bpe": bpe_codec.op7_bpe,
    "op8_packing": packing.op8_packing,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_mixing": mixing.op11_mixing,
    "op12_spelling": spelling.op12_spelling,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

ORACLES = {"op1_exact_dedup": exact_dedup.ORACLE, "op3_ngram_join": ngram_join.ORACLE, "op11_mixing": mixing.ORACLE, "op13_vector_codes": vector_codes.ORACLE}
