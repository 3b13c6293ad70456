"""The operators' queries over their whole tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import divergence, exact, licenses, mixing, ngram_lm, packing, pii, quality, rank_queue, simhash, tokens, urls, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": packing.query,
    "op2_exact_dedup": exact.query,
    "op3_url_filters": urls.query,
    "op4_license_scans": licenses.query,
    "op5_source_mixing": mixing.query,
    "op6_token_counts": tokens.query,
    "op7_simhash_near_dedup": simhash.query,
    "op8_lm_scoring": ngram_lm.query,
    "op9_quality_rules": quality.query,
    "op10_pii": pii.query,
    "op11_bpe_rank_queue": rank_queue.query,
    "op12_embedding_whitening": whitening.query,
    "op13_source_divergence": divergence.query,
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": exact.ORACLE,
    "op3_url_filters": urls.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
