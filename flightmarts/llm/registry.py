"""Queries of the operators, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from flightmarts.llm import (
    collocations,
    exact_dedup,
    importance_resampling,
    jaccard_join,
    mixing,
    pii,
    piece_codec,
    quality_classifier,
    quality_rules,
    secret_scan,
    suffix_dedup,
    token_counts,
    warc,
)

QUERIES = {
    "op1_quality_classifier": quality_classifier.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_piece_codec": piece_codec.query,
    "op4_mixing": mixing.query,
    "op5_exact_dedup": exact_dedup.query,
    "op6_token_counts": token_counts.query,
    "op7_warc": warc.query,
    "op8_quality_rules": quality_rules.query,
    "op9_jaccard_join": jaccard_join.query,
    "op10_pii": pii.query,
    "op11_collocations": collocations.query,
    "op12_secret_scan": secret_scan.query,
    "op13_importance_resampling": importance_resampling.query,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op7_warc": warc.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_importance_resampling": importance_resampling.ORACLE,
}
