"""Documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierfold.llm.common import release, table, written
from tierfold.llm.line_dedup import documents_without_lines
from tierfold.llm.mixing import mixed_documents
from tierfold.llm.packing import packed
from tierfold.llm.quality_rules import keep_good
from tierfold.llm.queries import tokenizer_files
from tierfold.llm.simhash import keep_one_of_each

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark, keep=docs)  # what earlier stages have written on their way
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark, keep=docs)  # what earlier stages have written on their way
    return documents_without_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark, keep=docs)  # what earlier stages have written on their way
    return keep_one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark, keep=docs)  # what earlier stages have written on their way
    return mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark, keep=docs)
    return packed(docs, *tokenizer_files(), with_ids=False).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("packing", sequences),
]

#: Fingerprints and token ids are not within reach of SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
