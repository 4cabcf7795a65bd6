"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketfold.llm import (bbit_minhash, chat_tools, cross_parsing, curriculum, decontam, filter_audit, gear_chunks, line_ledger, periodic_runs, pfor_tokens, pitman_yor,
                            quality_votes, url_templates)
from marketfold.llm.common import table


def op1_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gear_chunks.report(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.report(table(spark, sf_dir, "documents"))


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.report(table(spark, sf_dir, "documents"))


def op5_line_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_ledger.report(table(spark, sf_dir, "documents"))


def op8_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.report(table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    """Place of the vocabulary file; the public tokenizers are found at call time."""
    import public_tokenizers
    return public_tokenizers.path(pfor_tokens.VOCABULARY)


def op10_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor_tokens.report(table(spark, sf_dir, "documents"), vocabulary_path())


def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages"))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pitman_yor.report(docs, blocks=pitman_yor.file_blocks(docs))


def op9_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_tools.report(table(spark, sf_dir, "conversations"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_parsing.report(table(spark, sf_dir, "documents"))


QUERIES = (op1_gear_chunks, op2_decontamination, op3_quality_votes, op4_curriculum_mix, op5_line_ledger, op6_url_templates,
           op7_pitman_yor, op8_bbit_minhash, op9_chat_tools, op10_pfor_tokens, op11_periodic_runs,
           op12_filter_audit, op13_cross_parsing)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracles() -> dict[str, str]:
    from marketfold.llm.oracle_sql import ORACLES
    return dict(ORACLES)
