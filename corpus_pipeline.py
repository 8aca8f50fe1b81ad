"""Training-corpus pipeline over ``documents``: language, quality rules, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet to the shared folder and reread as the next stage's ``docs``.
All stages but the last return the columns of ``docs`` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerhawk.llm import langid, outliers, packing, simhash
from ledgerhawk.llm.common import keep, read, ready

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: A text stays if this share of its letters is in one language.
MIN_LANGUAGE_SHARE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a main language, go."""
    ready(spark)
    return langid.with_language(docs, MIN_LANGUAGE_SHARE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base limits or lie far outside their cell go."""
    ready(spark)
    return outliers.without_outliers(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    ready(spark)
    return simhash.one_per_component(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("packing", sequences),
]

#: The stages estimate models and follow links between documents: no SQL form; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
