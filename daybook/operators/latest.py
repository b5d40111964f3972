"""The latest value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_value(
    changes: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Per key the values of the row that comes last in the order.

    Works on tables and on streams; each task sends one row per key.
    """
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
        .select(*keys, *[F.col(f"_last.{name}").alias(name) for name in values])
    )
