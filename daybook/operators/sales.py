"""Summaries of sales records (region, category, month, amount).

Every summary starts from the cells region x category x month, so the records are reduced
before the first shuffle and all further steps work on the few cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

DIMENSIONS = ("region", "category", "month")


def sales_cells(sales: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Exact total and count per combination of the dimensions.

    Decimal amounts keep their scale. Amounts of floating point are added up with ten
    decimals; a total beyond 28 digits before the point fails the job.
    """
    amount = F.col("amount")
    if not isinstance(sales.schema["amount"].dataType, T.DecimalType):
        amount = amount.cast("decimal(38,10)")
    return sales.groupBy(*dimensions).agg(
        F.sum(amount).alias("total"), F.count("amount").alias("records")
    )


def _merged(total: str = "total", records: str = "records") -> list[Column]:
    return [F.sum(total).alias("total"), F.sum(records).alias("records")]


def _figures() -> list[Column]:
    total = F.col("total").cast("double")
    return [
        total.alias("total"),
        F.col("records").cast("long").alias("records"),
        (total / F.col("records")).alias("mean"),
    ]


def _level() -> Column:
    return F.grouping_id().cast("long").alias("level")


def sales_by(sales: DataFrame, *dimensions: str) -> DataFrame:
    """Total, count and mean by the given dimensions."""
    return sales_cells(sales, dimensions).select(*dimensions, *_figures())


def sales_cube(sales: DataFrame) -> DataFrame:
    """Region x category totals with subtotals and the grand total.

    ``level`` tells them apart: 0 for a cell, 1 for all categories, 2 for all regions, 3 for
    all. A NULL in a column that is not summed over is a value like any other.
    """
    cells = sales_cells(sales, ("region", "category"))
    return cells.cube("region", "category").agg(*_merged(), _level()).select(
        "region", "category", *_figures(), "level"
    )


def sales_rollup(sales: DataFrame) -> DataFrame:
    """Region x category totals with a subtotal per region and the grand total; see the cube."""
    cells = sales_cells(sales, ("region", "category"))
    return cells.rollup("region", "category").agg(*_merged(), _level()).select(
        "region", "category", *_figures(), "level"
    )


def sales_pivot(sales: DataFrame, months: Sequence[str]) -> DataFrame:
    """Totals per region with one column per month; NULL where nothing was sold.

    ``m_other`` has the total of all months that are not listed, and of records without one.
    """
    columns = [*months, "other"]
    month = F.when(F.col("month").isin(list(months)), F.col("month")).otherwise("other")
    cells = sales_cells(sales, ("region", "month")).withColumn("month", month)
    wide = cells.groupBy("region").pivot("month", columns).agg(F.sum("total"))
    return wide.select(
        "region", *[F.col(f"`{m}`").cast("double").alias(f"m_{m}") for m in columns]
    )


def top_category(sales: DataFrame) -> DataFrame:
    """The category with the highest total per region; on a tie the first by name."""
    cells = sales_cells(sales, ("region", "category"))
    total = F.col("total")
    rank = F.struct(total.isNull(), -total, "category")
    return (
        cells.groupBy("region")
        .agg(F.min_by(F.struct("category", "total"), rank).alias("top"))
        .select("region", "top.category", F.col("top.total").cast("double").alias("total"))
    )


def month_change(sales: DataFrame) -> DataFrame:
    """Total per region and month, and its difference from the month before in the table.

    The window runs over months, not records: a region has few.
    """
    cells = sales_cells(sales, ("region", "month"))
    before = F.lag("total").over(Window.partitionBy("region").orderBy("month"))
    return cells.select(
        "region",
        "month",
        F.col("total").cast("double").alias("total"),
        (F.col("total") - before).cast("double").alias("change"),
    )


def region_share(sales: DataFrame) -> DataFrame:
    """Total per region and its share of all sales."""
    cells = sales_cells(sales, ("region",))
    everything = cells.agg(F.sum("total").cast("double").alias("all")).scalar()
    total = F.col("total").cast("double")
    return cells.select("region", total.alias("total"), (total / everything).alias("share"))
