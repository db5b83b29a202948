"""Queries of the pipeline operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsewright.llm import decontaminate, divergence, jaccard, negatives, repeats, sketches
from pulsewright.llm.decontaminate import op1_fm_index_decontamination
from pulsewright.llm.divergence import op11_level_product_divergence
from pulsewright.llm.jaccard import op7_ngram_jaccard_join
from pulsewright.llm.language import op3_hyperdimensional_language
from pulsewright.llm.lines import op2_simhash_line_dedup
from pulsewright.llm.negatives import op13_threshold_hard_negatives
from pulsewright.llm.packing import op4_best_fit_packing
from pulsewright.llm.pii import op6_boosted_personal_data
from pulsewright.llm.quality import op9_risk_controlled_quality
from pulsewright.llm.repeats import op8_recompression_repeats
from pulsewright.llm.secrets import op5_markov_secret_scan
from pulsewright.llm.sharding import op10_interleaved_shards
from pulsewright.llm.sketches import op12_bottom_k_near_dedup

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_fm_index_decontamination,
        op2_simhash_line_dedup,
        op3_hyperdimensional_language,
        op4_best_fit_packing,
        op5_markov_secret_scan,
        op6_boosted_personal_data,
        op7_ngram_jaccard_join,
        op8_recompression_repeats,
        op9_risk_controlled_quality,
        op10_interleaved_shards,
        op11_level_product_divergence,
        op12_bottom_k_near_dedup,
        op13_threshold_hard_negatives,
    )
}


def llm_queries() -> dict[str, Query]:
    return dict(QUERIES)


def llm_oracles() -> dict[str, str]:
    return {
        "op1_fm_index_decontamination": decontaminate.ORACLE,
        "op7_ngram_jaccard_join": jaccard.ORACLE,
        "op8_recompression_repeats": repeats.ORACLE,
        "op11_level_product_divergence": divergence.ORACLE,
        "op12_bottom_k_near_dedup": sketches.ORACLE,
        "op13_threshold_hard_negatives": negatives.ORACLE,
    }
