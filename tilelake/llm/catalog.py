"""Queries of the training-data operators and the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, jaccard, media, mixing, packing, pii, quality, rollups, secret_scan, token_files
from .common import ship

_QUERIES = {
    "op1_mixing": (mixing.op1_mixing, mixing.SQL),
    "op2_jaccard_join": (jaccard.op2_jaccard_join, jaccard.SQL),
    "op3_secret_scan": (secret_scan.op3_secret_scan, secret_scan.SQL),
    "op4_best_fit_packing": (packing.op4_best_fit_packing, None),
    "op5_token_files": (token_files.op5_token_files, None),
    "op6_pii": (pii.op6_pii, None),
    "op7_exact_dedup": (exact_dedup.op7_exact_dedup, exact_dedup.SQL),
    "op8_tiff_media": (media.op8_tiff_media, None),
    "op9_quality": (quality.op9_quality, None),
    "op10_token_rollups": (rollups.op10_token_rollups, rollups.SQL),
}


def _run(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(f) for name, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
