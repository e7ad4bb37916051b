"""Registered queries of the operators and, where SQL can express them, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import bpe, chat_format, decontaminate, exact_dedup, langid, license_scan, periodic, quality, secret_scan, simhash, spelling, substring_dedup, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "op1_license_scan": license_scan.query,
        "op2_byte_bpe": bpe.query,
        "op3_decontamination": decontaminate.query,
        "op4_chat_format": chat_format.query,
        "op5_warc_derivatives": warc.query,
        "op6_language_id": langid.query,
        "op7_quality": quality.query,
        "op8_simhash": simhash.query,
        "op9_substring_dedup": substring_dedup.query,
        "op10_exact_dedup": exact_dedup.query,
        "op11_spelling_variants": spelling.query,
        "op12_periodic_runs": periodic.query,
        "op13_secret_scan": secret_scan.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """The twin of op4 has the contract's columns and the query's own; op9's twin has
    the contract's."""
    return {
        "op3_decontamination": decontaminate.SQL,
        "op4_chat_format": chat_format.SQL,
        "op9_substring_dedup": substring_dedup.SQL,
        "op10_exact_dedup": exact_dedup.SQL,
        "op11_spelling_variants": spelling.SQL,
        "op12_periodic_runs": periodic.SQL,
        "op13_secret_scan": secret_scan.SQL,
    }
