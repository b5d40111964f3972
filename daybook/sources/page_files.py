"""HTML files as a page table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per HTML file: its address, a number made of the address, and its text."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")
    )
    return files.select(F.xxhash64("url").alias("page_id"), "url", "html")
