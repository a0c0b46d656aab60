"""The corpus pipeline: five stages, each one of the corpus operators.

Every stage works on all that its predecessor kept and its decisions take effect: the
first four return the documents they keep, with the columns of ``documents``; the last
returns one row per packed piece. Between stages the documents are written as Parquet
and read again, so a lost executor costs at most a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civicmart.llm import decontam, exact_dedup, langid, packing, simhash_dedup
from civicmart.llm.common import bound_batches, read_table, scratch, ship_package, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _for_workers(spark: SparkSession) -> None:
    """What stages with Python workers need: the package, and batches that leave executors room."""
    ship_package(spark)
    bound_batches(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or without a letter go."""
    _for_workers(spark)
    return langid.with_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text (but for white space) the longest stays."""
    ship_package(spark)
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest doc_id stays."""
    _for_workers(spark)
    return simhash_dedup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece with its place."""
    _for_workers(spark)
    return packing.best_fit(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Model-based and iterative stages: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), scratch(spark, f"stage-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
