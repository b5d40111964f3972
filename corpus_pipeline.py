"""A corpus pipeline over the documents: rules, near-duplicates, passages, secrets, packing.

Each stage takes all that its predecessor kept, as a table that was written and read again.
All stages but the last return the columns of the documents, whatever other columns there are.

Defined results: a null or empty text has no words, so the first stage rejects it. Rows that
repeat an id are documents of their own until the second stage, where one of those with equal
texts stays. Texts are handled as a whole, of any length. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm.packing import packed
from daybook.llm.quality import keep_good
from daybook.llm.saving import saved
from daybook.llm.secret_scan import mask_secrets
from daybook.llm.simhash import keep_one
from daybook.llm.suffixes import without_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, in steps, the one with the smallest id stays."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand in a document with a smaller id are cut out."""
    return without_repeats(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their bins."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL can't express the fingerprints, so the pipeline has a brute-force twin in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = saved(docs, name)
    return docs
