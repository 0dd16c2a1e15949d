"""The queries of this subpackage, each over whole tables with production parameters."""

from __future__ import annotations

import corpus_pipeline
from marlstone.llm import (
    automaton,
    centroids,
    exact_dedup,
    language_id,
    near_dedup,
    packing,
    piece_dropout,
    quality_rank,
    quality_rules,
    token_files,
    toxicity,
    warc,
    whitening,
)

QUERIES = {
    "op1_minhash_forest": near_dedup.op1_minhash_forest,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_token_files": token_files.op5_token_files,
    "op6_quality_rank": quality_rank.op6_quality_rank,
    "op7_warc": warc.op7_warc,
    "op8_language_id": language_id.op8_language_id,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_piece_dropout": piece_dropout.op10_piece_dropout,
    "op11_centroid_clustering": centroids.op11_centroid_clustering,
    "op12_merge_automaton": automaton.op12_merge_automaton,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op2_exact_dedup": exact_dedup.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op9_quality_rules": quality_rules.ORACLE_SQL,
    "op11_centroid_clustering": centroids.ORACLE_SQL,
}
