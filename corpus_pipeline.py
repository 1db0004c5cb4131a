"""A training corpus from documents, stage by stage.

Every stage reads what the one before wrote, and calls one operator of ``hirelake.llm``:
documents without a determined language go, of equal texts and of near duplicates one stays,
sources are mixed to their targets, and the mix is packed into sequences. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm.common import staged, table
from hirelake.llm.exact_dedup import drop_copies
from hirelake.llm.langid import known_language
from hirelake.llm.mixing import mixed_rows
from hirelake.llm.near_dedup import drop_near_copies
from hirelake.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is determined. Null, empty and letterless texts go; without
    any labelled row nothing is determined and all go."""
    return known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; null counts as empty, of rows that repeat
    both text and id one stays."""
    return drop_copies(docs, from_files=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays. Rows without an id or
    without words are no one's copy and stay."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, none to three times. Rows without words have size 0 and
    follow the copies of their place; a null source is a source of its own."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of documents; the last stage, with its own columns. Rows without words need no room."""
    return pack(docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixing", mixing), ("packing", packing)]

# Language models cannot be trained in SQL: the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
