"""Small tables written in code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The cities on offer and their labels.
CITIES = {"Seoul": "서울", "Busan": "부산", "Gwangju": "광주", "Daejeon": "대전"}


def item_table(
    spark: SparkSession, items: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """Literal items with their position."""
    rows = [(position, *item) for position, item in enumerate(items)]
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.createDataFrame(
        rows, T.StructType([T.StructField("pos", T.IntegerType(), False), *fields.fields])
    )


def code_table(
    spark: SparkSession, labels: Mapping[str, str], code: str = "code", label: str = "label"
) -> DataFrame:
    """Codes and labels. The size is that of the literal, so joins may broadcast it."""
    return F.broadcast(
        spark.createDataFrame(list(labels.items()), f"{code} string, {label} string")
    )
