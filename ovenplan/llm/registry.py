"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ovenplan.llm import (
    concat_cut,
    context_tree,
    lang_id,
    lexical,
    line_dedup,
    packing,
    periodic,
    piece_bpe,
    pii,
    quality,
    secret_scan,
    simhash,
    vector_dedup,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        context_tree.op1_lm_scoring,
        line_dedup.op2_line_dedup,
        vector_dedup.op3_vector_near_dedup,
        quality.op4_quality_rules,
        piece_bpe.op5_piece_bpe,
        pii.op6_pii,
        secret_scan.op7_secret_scan,
        packing.op8_best_fit_packing,
        lang_id.op9_language_id,
        simhash.op10_simhash_near_dedup,
        concat_cut.op11_concat_and_cut,
        periodic.op12_periodic_runs,
        lexical.op13_ranked_search,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.ORACLE, "op13_ranked_search": lexical.ORACLE}
