"""Ranks, running totals and shares over the order of a whole table.

A window without keys would put the table into one task. Here the order is cut into segments
at values out of a bounded sample. Each segment is numbered by a task of its own, the counts
and totals of the segments before it, one short row per segment, are added to that.

Ranks and running totals depend on the value only, so they are computed for the distinct
values, after counts and totals per value have been formed before the shuffle, and looked up
for the rows: a value that a third of the rows have is one row. Row numbers need an order
that tells rows apart; rows that are equal in it stay in one segment and get the numbers
that follow each other, which of them gets which is open.

Orders are ascending with NULL first; for a descending order give the negated column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.operators.lookups import Salting, lookup_join
from daybook.operators.segments import SEGMENT, CUTS_OF_KEY, Cutting, add_segments
from daybook.session import saved_table, shared_folder

_ALL = "_all"
_KEYS = [_ALL]


def _cut(df: DataFrame, order: Sequence[str], cutting: Cutting, cut_from: DataFrame | None) -> DataFrame:
    """The segment of each row of the table as one group."""

    def grouped(table: DataFrame) -> DataFrame:
        # A constant would be folded away, and its joins become nested loops.
        return table.withColumn(_ALL, F.pmod(F.xxhash64(*order), F.lit(1)).cast("int"))

    places = None if cut_from is None else grouped(cut_from)
    return add_segments(grouped(df), _KEYS, order, cutting, places).drop(CUTS_OF_KEY)


def _before(sums: DataFrame, columns: dict[str, str]) -> DataFrame:
    """What all earlier segments hold, by segment; as many rows as segments."""
    earlier = Window.partitionBy(_ALL).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    kept = saved_table(sums, "segment-sums")
    return kept.select(
        F.col(SEGMENT).alias("_at_segment"),
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(into) for name, into in columns.items()],
    )


def _with_before(df: DataFrame, before: DataFrame) -> DataFrame:
    on = df[SEGMENT] == before["_at_segment"]
    return df.join(F.broadcast(before), on).drop("_at_segment")


def row_numbers(
    df: DataFrame,
    order: Sequence[str],
    into: str = "number",
    cutting: Cutting = Cutting(),
    cut_from: DataFrame | None = None,
) -> DataFrame:
    """Add the number of each row in the order of the whole table, from 1.

    ``df`` is read twice; ``cut_from`` may name a cheaper table with the same order columns,
    out of which the cuts are chosen.
    """
    cut = _cut(df, order, cutting, cut_from)
    sums = cut.groupBy(_ALL, SEGMENT).agg(F.count("*").alias("_rows"))
    before = _before(sums, {"_rows": "_rows_before"})
    inside = F.row_number().over(Window.partitionBy(SEGMENT).orderBy(*order))
    numbered = _with_before(cut.withColumn(into, inside.cast("bigint")), before)
    return numbered.withColumn(into, F.col(into) + F.col("_rows_before")).select(*df.columns, into)


def tiles(
    df: DataFrame,
    order: Sequence[str],
    count: int,
    into: str = "tile",
    cutting: Cutting = Cutting(),
) -> DataFrame:
    """Add which of ``count`` parts of equal size a row belongs to; the first ones may have
    one row more."""
    number = "_number"
    rows = df.count()
    size, larger = divmod(rows, count)
    edge = larger * (size + 1)
    place = F.col(number) - 1
    part = F.when(place < edge, F.floor(place / (size + 1))).otherwise(
        larger + F.floor((place - edge) / max(size, 1))
    )
    numbered = row_numbers(df, order, number, cutting)
    return numbered.select(*df.columns, (part + 1).cast("bigint").alias(into))


def value_ranks(
    df: DataFrame, order: Sequence[str], measure: str | None = None, cutting: Cutting = Cutting()
) -> DataFrame:
    """(order columns, rows, rank, dense_rank, total) of the distinct values.

    ``rank`` counts the rows before, ``total`` adds up the measure of all rows up to the
    value, its own rows included; it has the type of a sum of the measure.
    """
    amount = F.sum(measure) if measure else F.lit(None).cast("bigint")
    values = df.groupBy(*order).agg(F.count("*").alias("rows"), amount.alias("_amount"))
    kept = _kept(values)
    cut = _cut(kept, order, cutting, None)
    sums = cut.groupBy(_ALL, SEGMENT).agg(
        F.sum("rows").alias("_rows"), F.count("*").alias("_values"), F.sum("_amount").alias("_sum")
    )
    before = _before(sums, {"_rows": "_rows_before", "_values": "_values_before", "_sum": "_sum_before"})
    upto = Window.partitionBy(SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = cut.select(
        *order,
        SEGMENT,
        "rows",
        (F.sum("rows").over(upto) - F.col("rows")).alias("_rows_inside"),
        F.row_number().over(upto).alias("_number"),
        F.sum("_amount").over(upto).alias("_total"),
    )
    kind = kept.schema["_amount"].dataType
    return _with_before(inside, before).select(
        *order,
        "rows",
        (F.col("_rows_before") + F.col("_rows_inside") + 1).alias("rank"),
        (F.col("_values_before") + F.col("_number")).cast("bigint").alias("dense_rank"),
        (F.col("_sum_before") + F.coalesce("_total", F.lit(0))).cast(kind).alias("total"),
    )


def _kept(values: DataFrame) -> DataFrame:
    """The distinct values, kept in the shared folder: they are read several times."""
    path = shared_folder(values.sparkSession, "values")
    values.write.parquet(path)
    return values.sparkSession.read.schema(values.schema).parquet(path)


def ranked_rows(
    df: DataFrame,
    order: Sequence[str],
    measure: str | None = None,
    cutting: Cutting = Cutting(),
    salting: Salting = Salting(),
) -> DataFrame:
    """Add rank, dense_rank and running total to each row; order columns hold no NULL."""
    ranks = value_ranks(df, order, measure, cutting).drop("rows")
    return lookup_join(df, ranks, order, salting=salting)


def top_with_ties(df: DataFrame, order: Sequence[str], count: int) -> DataFrame:
    """The rows whose rank is at most ``count``, all rows of the last value included.

    The first ``count`` distinct values hold them all; these are found by a sort that keeps
    no more, and only their rows are fetched. ``count`` bounds what is broadcast.
    """
    values = df.groupBy(*order).agg(F.count("*").alias("_rows"))
    first = saved_table(values.orderBy(*order).limit(count), "first-values")
    before = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = first.select(*order, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) + 1).alias("rank"))
    wanted = ranks.filter(F.col("rank") <= count)
    renamed = wanted.withColumnsRenamed({name: f"_at_{name}" for name in order})
    on = [df[name].eqNullSafe(renamed[f"_at_{name}"]) for name in order]
    return df.join(F.broadcast(renamed), on).select(*[df[name] for name in df.columns], "rank")
