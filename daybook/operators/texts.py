"""Rows to text, in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.operators.segments import (
    CUTS_OF_KEY,
    SEGMENT,
    Cutting,
    add_segments,
    earlier_segments,
    join_per_segment,
    segment_window,
)

# Heading and line format of an item list.
BAG_HEADING = "What's in my bag?\n\n"
ITEM_MARK = "🌀"
ITEM_UNIT = "개"

LINES_PER_PART = 100_000


def item_line(name: Column, count: Column) -> Column:
    """One item as a line of text."""
    return F.concat(F.lit(ITEM_MARK), name, count.cast("string"), F.lit(ITEM_UNIT + "\n"))


def _joined(numbered: DataFrame, keys: Sequence[str], lines_per_part: int) -> DataFrame:
    """The lines of each part as one text; a part has few enough lines for one task."""
    part = F.floor((F.col("_place") - 1) / lines_per_part).alias("part")
    lines = F.sort_array(F.collect_list(F.struct("_place", "_line")))
    return numbered.groupBy(*keys, part).agg(
        F.array_join(F.transform(lines, lambda item: item["_line"]), "").alias("text")
    )


def ordered_text(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    line: Column,
    heading: str = "",
    lines_per_part: int = LINES_PER_PART,
    cutting: Cutting = Cutting(),
    cut_from: DataFrame | None = None,
) -> DataFrame:
    """Per key the lines joined in order, as numbered parts of ``lines_per_part`` lines.

    Most keys have one part, numbered 0. A longer text continues in further parts, since one
    cell can't grow without end; joined by number they are the whole text.
    """
    lines = rows.select(*keys, *order, F.coalesce(line, F.lit("")).alias("_line"))
    cut = add_segments(lines, keys, order, cutting, cut_from)
    short = cut.filter(F.col(CUTS_OF_KEY) == 0).withColumn(
        "_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    long = cut.filter(F.col(CUTS_OF_KEY) > 0)
    earlier = (
        long.groupBy(*keys, SEGMENT)
        .agg(F.count("*").alias("_lines"))
        .select(*keys, SEGMENT, F.sum("_lines").over(earlier_segments(keys)).alias("_earlier"))
    )
    placed = join_per_segment(
        long.withColumn("_place", F.row_number().over(segment_window(keys, order))), earlier, keys
    ).withColumn("_place", F.col("_place") + F.coalesce("_earlier", F.lit(0)))
    parts = _joined(short, keys, lines_per_part).unionByName(
        _joined(placed, keys, lines_per_part)
    )
    if not heading:
        return parts
    first = F.when(F.col("part") == 0, heading).otherwise("")
    return parts.withColumn("text", F.concat(first, "text"))
