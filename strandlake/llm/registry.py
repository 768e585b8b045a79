"""Queries of this subpackage; SQL where DuckDB can express the result."""

from __future__ import annotations

from .centroids import op11_elkan_clusters
from .class_lm import op3_class_lm_scores
from .decontamination import op6_benchmark_decontamination
from .line_dedup import op9_line_dedup
from .mixing import op10_mixing
from .near_duplicates import op4_simhash_near_dedup
from .oracles import decontamination_sql, line_dedup_sql, mixing_sql, passages_sql, quality_sql, suffix_dedup_sql
from .quality_rules import op2_quality_rules
from .secret_scan import op1_secret_scan
from .sharding import op7_sharding
from .suffix_dedup import op8_suffix_dedup
from .token_counts import op5_token_counts
from .vector_codes import op13_vector_codes
from .vector_oracles import elkan_clusters_sql, vector_codes_sql
from .word_windows import op12_fm_passages

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_class_lm_scores": op3_class_lm_scores,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_sharding": op7_sharding,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_elkan_clusters": op11_elkan_clusters,
    "op12_fm_passages": op12_fm_passages,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES: dict[str, str] = {
    "op2_quality_rules": quality_sql(),
    "op6_benchmark_decontamination": decontamination_sql(),
    "op8_suffix_dedup": suffix_dedup_sql(),
    "op9_line_dedup": line_dedup_sql(),
    "op10_mixing": mixing_sql(),
    "op11_elkan_clusters": elkan_clusters_sql(),
    "op12_fm_passages": passages_sql(),
    "op13_vector_codes": vector_codes_sql(),
}
