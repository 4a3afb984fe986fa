"""One query per operator over its whole table, and the DuckDB checks where SQL can express it."""

from __future__ import annotations

from bankpulse.llm import (
    language_id, licenses, mixing, neighbours, ngram_join, packing, periodic, pii, quality, secrets, sharding,
    token_counts, variants,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_language_id": language_id.op2_language_id,
    "op3_sharding": sharding.op3_sharding,
    "op4_pii": pii.op4_pii,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_mixing": mixing.op7_mixing,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_secrets": secrets.op10_secrets,
    "op11_licenses": licenses.op11_licenses,
    "op12_variants": variants.op12_variants,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}

CHECKS = {
    "op3_sharding": sharding.ORACLE, "op6_ngram_join": ngram_join.ORACLE, "op7_mixing": mixing.ORACLE,
    "op12_variants": variants.ORACLE,
}
