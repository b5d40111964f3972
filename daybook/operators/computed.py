"""Costly columns, computed once per row."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.segments import hashable

#: Rows of a task, where each row takes much more work than its bytes in the file tell.
ROWS_OF_TASK = 2000


def spread(df: DataFrame, rows_of_task: int = ROWS_OF_TASK) -> DataFrame:
    """Deal rows to tasks by their number; a scan deals them by the bytes of the file.

    A narrow table has few bytes, so its scan has one task or a few, whatever is made of its
    rows. Rows go by the hash of all columns, so a task that runs again gives the same rows.
    """
    tasks = math.ceil(df.count() / rows_of_task)
    return df.repartition(tasks, F.xxhash64(*hashable(df))) if tasks > 1 else df


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once, however often later steps use them.

    A filter on a column of a plain projection is pushed below it, with a copy of the whole
    expression for each use. The generator keeps such filters above.
    """
    made = [column.alias(name) for name, column in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*made))))
