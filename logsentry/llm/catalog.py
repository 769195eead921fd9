"""The registered queries of this subpackage, and the SQL of those that have one."""

from __future__ import annotations

from logsentry.llm import (
    byte_bpe, exact_dedup, line_dedup, merkle, minhash, mixing, periodic, quality, secret_scan, sharding, token_counts, toxicity, url_filter,
)

QUERIES = {
    "op1_minhash_near_dedup": minhash.query,
    "op2_url_filter": url_filter.query,
    "op3_line_dedup": line_dedup.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_quality_rules": quality.query,
    "op6_toxicity": toxicity.query,
    "op7_mixing": mixing.query,
    "op8_byte_bpe": byte_bpe.query,
    "op9_sharding": sharding.query,
    "op10_token_counts": token_counts.query,
    "op11_periodic_runs": periodic.query,
    "op12_secret_scan": secret_scan.query,
    "op13_merkle_manifest": merkle.query,
}

ORACLES = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op5_quality_rules": quality.ORACLE,
}
