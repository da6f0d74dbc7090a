"""The corpus pipeline: each stage works on all that the one before it kept.

Every stage takes any ``docs`` with the columns of documents (more columns are carried, whatever their names) and keeps rows
whole, nulls included: null and empty texts are not toxic, hold no lines, shingles or benchmark passages and are kept; null
ids and sources are carried; an empty table gives an empty result; texts of any length are read whole.  Repeated rows: toxicity,
decontamination and mixing treat them alike, one after another; line dedup takes rows that agree in id and text as one document;
the n-gram join keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from standbyspark.llm import decontamination, line_dedup, mixing, ngram_join, toxicity
from standbyspark.llm.common import forgotten, staged, table

#: Of a text that lost lines, the share that must be left: what is under it is the remainder of a near copy.
LEAST_LEFT = 0.2


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go; null and empty texts and equal rows are scored alike, ids are not read."""
    return toxicity.accepted(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated line windows are cut out; texts go of which under a fifth is left.

    The first occurrence is that of the least id (nulls last); a text that loses no line stays as it is, empty or not.
    """
    return line_dedup.deduplicated(docs, least_left=LEAST_LEFT)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8): that of the least id, nulls last.

    Documents without words all stay; of a row repeated in full one stays.
    """
    return ngram_join.one_of_each(docs, width=5, num=80, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, with all rows of the same id and text; an empty benchmark removes nothing."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their place in the mix of sources; null sources share the weight of the others."""
    return mixing.mixed(docs, mixing.WEIGHTS, mixing.OTHER)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_join_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]

#: The toxicity model and its decoder have no SQL form; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder.  Each stage's rows are written as Parquet and read again, and the files of the stage before it are then removed."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, written = staged(stage(spark, docs, sf_dir), name)
        if before:
            forgotten(spark, before)
        before = written
    return docs
