"""From raw documents to packed training sequences, stage by stage.

Every stage is a function of the session, the documents left so far and the folder of tables. ``run``
writes what each stage returns as Parquet in the shared folder and reads it back for the next one. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statloom.llm import language_id, near_dup, quality, queries
from statloom.llm.common import materialise

#: Documents surer than this are in a language that was learned; a single short word can be less sure.
LANGUAGE_LEAST = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are clearly of the best grade (good and not toxic)."""
    model = quality.fit(docs, queries.table(spark, sf_dir, "labels"), quality.grade(), top=2)
    return quality.select(docs, model, wanted=2)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with letters whose language is told with some confidence."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.select(docs, model, LANGUAGE_LEAST)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicate texts, that of the smallest id."""
    return near_dup.distinct_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left; with a small cache, as the executors hold more by now than in a run of its own."""
    return queries.packed(docs, cache_bytes=24 << 20)


STAGES = [("quality", good_quality), ("language", known_language), ("near_duplicates", one_of_each), ("packing", packed)]

#: SQL cannot express the fitted stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
