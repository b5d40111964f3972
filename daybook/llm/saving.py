"""Intermediate tables in the shared folder; a job that loses executors reads them again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from daybook.session import shared_folder


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Compute a table once and read it back, which also cuts its lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
