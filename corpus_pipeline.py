"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, token files.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``.
The mix returns one row per take in training order, and the last stage writes
the token files in that order (file number, then row of the file).

Null, empty and repeated rows: null and empty texts fail the quality rules;
rows that repeat an id are documents of their own there and in decontamination,
and near-dedup keeps one row of each group whatever the ids (null ids rank
last); an empty table passes through every stage empty.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketfold.llm import bbit_minhash, curriculum, decontam, pfor_tokens, quality_votes
from marketfold.llm.common import table
from marketfold.llm.queries import vocabulary_path
from marketfold.session import cut_lineage, cuts, drop_cuts, ensure_session_defaults, ship_package


# By application: tables that the last stage wrote for itself.  Its result has
# been written when the next stage starts, so they are deleted then.
_scratch: dict[str, list[str]] = {}


def _stage(function):
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_session_defaults(spark)
        ship_package(spark)
        app = spark.sparkContext.applicationId
        drop_cuts(spark, _scratch.pop(app, []))
        before = len(cuts(spark))
        out = function(spark, docs, sf_dir)
        _scratch[app] = cuts(spark)[before:]
        return out
    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the vote model reject go."""
    return quality_votes.keep_good(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8)."""
    return bbit_minhash.keep_one(docs, k=5, similarity=0.8)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages over the coverage limit go, the others
    lose their passages of a window's words or more (13)."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=13, min_span=13, length_column="n_chars")


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per take of a document, in training order."""
    return curriculum.mix(docs)


@_stage
def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the rows read; per row its place in them."""
    file = F.col("_metadata.file_name")
    ordered = docs.select("doc_id", "text", F.regexp_extract(file, r"part-(\d+)", 1).try_cast("long").alias("_part"),
                          file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    path = pfor_tokens.fresh_path(spark)
    pfor_tokens.write_tokens(ordered, path, vocabulary_path(), order=("_part", "_file", "_row"))
    return pfor_tokens.token_index(spark, path)


STAGES = [("quality rules", quality), ("minhash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("mixing to target weights", mixing), ("token output", token_files)]

# EM and MinHash cannot be stated in SQL on whole tables; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if kept:
            drop_cuts(spark, [kept])
        kept = cuts(spark)[-1]
    return STAGES[-1][1](spark, docs, sf_dir)
