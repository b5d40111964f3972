"""Equi-joins of two large tables in which a key may hold a third of both sides.

All rows of a key meet all rows of the key on the other side, so it doesn't help to salt one
of them. A hot key becomes a grid: its left rows are dealt to the grid's rows and repeated
for each of its columns, its right rows are dealt to the columns and repeated for each row.
Each pair meets in just one cell, and each cell is a group of its own for the shuffle. Keys
that are not hot are grids of one cell.

Whether a row has a partner depends on its key alone. So semi and anti joins look the key up
in the distinct keys of the other side, and outer joins are the pairs and the rows without a
partner. NULL keys never match, and they don't travel through the inner join.

The pairs of a key are the product of its rows on both sides, so listing them is quadratic.
Where only sums over the pairs are wanted, ``counted`` makes rows that are equal in the columns
which matter into one row with their number, before the join: a pair of such rows then stands
for the product of their numbers.

The salt is a hash of the row, so a task that runs again gives the same rows. Rows that are
equal in all columns stay together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.lookups import Salting, lookup_join
from daybook.operators.segments import hash_sample, hashable, same_keys
from daybook.session import saved_table

KINDS = ("inner", "left", "right", "full", "semi", "anti")
_ROW, _COLUMN = "_grid_row", "_grid_column"
_ROWS, _COLUMNS = "_grid_rows", "_grid_columns"


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys]))


def _parts(df: DataFrame, keys: Sequence[str], into: str, salting: Salting) -> DataFrame:
    """The parts that the rows of a key are dealt to, for keys with more than one."""
    stride = max(1, math.ceil(df.count() / salting.sample_rows))
    parts = F.ceil(F.count("*") / salting.sample_rows_per_part).cast("int").alias(into)
    sample = hash_sample(df, hashable(df), stride)
    return sample.groupBy(*[F.col(key).alias(f"_hot_{key}") for key in keys]).agg(parts).filter(F.col(into) > 1)


def grids(left: DataFrame, right: DataFrame, keys: Sequence[str], salting: Salting) -> DataFrame:
    """Rows and columns of the grid of each hot key; their number is bounded by the samples."""
    names = [f"_hot_{key}" for key in keys]
    rows = _parts(left, keys, _ROWS, salting)
    columns = _parts(right, keys, _COLUMNS, salting)
    both = rows.join(columns, names, "full").select(
        *names, *[F.coalesce(name, F.lit(1)).alias(name) for name in (_ROWS, _COLUMNS)]
    )
    return saved_table(both, "grids")


def _dealt(df: DataFrame, keys: Sequence[str], hot: DataFrame, own: tuple, other: tuple) -> DataFrame:
    """Deal each row to its part of the grid and repeat it for all parts of the other side."""
    content = F.xxhash64(*hashable(df))
    found = df.join(F.broadcast(hot), same_keys(df, hot, keys, "_hot_"), "left")
    parts, repeats = (F.coalesce(name, F.lit(1)) for name in (own[1], other[1]))
    return found.select(
        *[df[name] for name in df.columns],
        F.pmod(content, parts).cast("int").alias(own[0]),
        F.explode(F.sequence(F.lit(0), repeats - 1)).alias(other[0]),
    )


def grid_sides(
    left: DataFrame, right: DataFrame, keys: Sequence[str], salting: Salting
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cells of the grid that each row belongs to."""
    hot = grids(left, right, keys, salting)
    row, column = (_ROW, _ROWS), (_COLUMN, _COLUMNS)
    return _dealt(left, keys, hot, row, column), _dealt(right, keys, hot, column, row)


def _pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], salting: Salting) -> DataFrame:
    left, right = _known(left, keys), _known(right, keys)
    if max(left.count(), right.count()) <= salting.smallest_table:
        return left.join(right, list(keys))
    one, other = grid_sides(left, right, keys, salting)
    return one.join(other, [*keys, _ROW, _COLUMN]).drop(_ROW, _COLUMN)


def _with_partner(
    df: DataFrame, other: DataFrame, keys: Sequence[str], salting: Salting, wanted: bool
) -> DataFrame:
    there = _known(other, keys).select(*keys).distinct().withColumn("_there", F.lit(True))
    found = lookup_join(df, there, keys, salting=salting)
    condition: Column = F.col("_there").isNotNull()
    return found.filter(condition if wanted else ~condition).select(*df.columns)


def counted(df: DataFrame, columns: Sequence[str], **counts: Column) -> DataFrame:
    """The different rows of the columns, NULLs too, each with counts of its rows."""
    return df.groupBy(*columns).agg(*[count.alias(name) for name, count in counts.items()])


def skewed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salting: Salting = Salting(),
) -> DataFrame:
    """Join on equal keys; columns are the keys, the others of the left and of the right side.

    Both sides must not share other names. Semi and anti joins keep the left side's columns.
    """
    if how not in KINDS:
        raise ValueError(f"how must be one of {', '.join(KINDS)}")
    if how in ("semi", "anti"):
        return _with_partner(left, right, keys, salting, how == "semi")
    shared = set(left.columns) & set(right.columns) - set(keys)
    if shared:
        raise ValueError(f"both sides have {', '.join(sorted(shared))}")
    own, added = ([name for name in df.columns if name not in keys] for df in (left, right))
    joined = _pairs(left, right, keys, salting).select(*keys, *own, *added)

    def alone(df: DataFrame, other: DataFrame) -> DataFrame:
        single = _with_partner(df, other, keys, salting, False)
        missing = [F.lit(None).cast(joined.schema[name].dataType).alias(name) for name in joined.columns if name not in df.columns]
        return single.select("*", *missing).select(*joined.columns)

    if how in ("left", "full"):
        joined = joined.unionByName(alone(left, right))
    if how in ("right", "full"):
        joined = joined.unionByName(alone(right, left))
    return joined
