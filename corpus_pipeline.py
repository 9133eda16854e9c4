"""A corpus pipeline over ``documents``: its stages in order, each a function of (spark, docs, sf_dir).

A document is rejected if its quality classifier says so, or if a near copy of smaller id
stays, or if it contains a benchmark item; personal data is replaced in those that are left,
and the last stage mixes them to the target weights (a row for each copy taken).

Defined results: a null or empty text is judged by its length alone, is no near copy, holds
no item and no personal data, and is never taken into the mix; rows that repeat one document
stay or go together, until the mix takes each by itself; a null doc_id is linked with
nothing; a null source is mixed as the last source; extra columns pass through all stages,
whatever their names (one named like a column of the mix gets ``_in`` after its name); empty
tables give no rows.  Each stage is a table of its own, so a lost executor repeats no stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import decontaminate, mixing, near_dup, pii, quality
from leafmill.llm.scratch import keep, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8."""
    return near_dup.without_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document taken, with its shard and order."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]
ORACLE_SQL = None  # trained models are not expressible in SQL; tests/llm/test_pipeline.py compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
