"""Registered queries of the corpus operators: opN_<name>, and the pipeline where corpus_pipeline.py is there."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import ship_package
from .decontaminate import op2_decontamination
from .embedding_dedup import OP11_SQL, op11_embedding_dedup
from .fingerprint import op5_fingerprints
from .jaccard_join import op7_jaccard_join
from .language_id import op4_language_id
from .merkle import OP12_SQL, op12_merkle_manifest
from .packing import op10_best_fit_packing
from .paragraphs import op3_substring_dedup
from .suffix_dedup import op1_suffix_dedup
from .token_count import op9_token_counts
from .toxicity import op6_toxicity
from .url_rules import OP8_SQL, op8_url_rules
from .whitening import op13_embedding_whitening


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: shipped(f)
    for f in (
        op1_suffix_dedup,
        op2_decontamination,
        op3_substring_dedup,
        op4_language_id,
        op5_fingerprints,
        op6_toxicity,
        op7_jaccard_join,
        op8_url_rules,
        op9_token_counts,
        op10_best_fit_packing,
        op11_embedding_dedup,
        op12_merkle_manifest,
        op13_embedding_whitening,
    )
}

ORACLES: dict[str, str] = {"op8_url_rules": OP8_SQL, "op11_embedding_dedup": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
