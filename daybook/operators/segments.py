"""Ordered work per key that does not need the whole key in one task.

A running value needs the rows of a key in order. A plain window puts every row of a key
into one task, and one key may hold a third of a table. Here the order of such a key is cut
into segments, each a run of neighbouring rows. A window works inside the segments, and
what crosses a cut is carried over on one row per segment.

The cut points come from a sample chosen by a hash of key and order. The sample only says
where to cut; each row takes part, and the results do not depend on the cuts. The sample,
the cut points and the carried rows are bounded, whatever the size of the table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from daybook.session import saved_table

SEGMENT = "_segment"
CUTS_OF_KEY = "_cuts_of_key"
_RANK = "_rank"
_PLACE = "_place"
_NUMBER = "_number"
_COARSE = "_coarse"
_FINE = "_fine"
_GROUP = "_group"


@dataclass(frozen=True)
class Cutting:
    """How fine to cut: about ``sample_rows`` rows are looked at, and a segment holds
    about ``sample_rows_per_segment`` of them, yet never fewer than ``smallest_segment``
    rows of the table. There are at most sample_rows / sample_rows_per_segment cuts.
    """

    sample_rows: int = 200_000
    sample_rows_per_segment: int = 16
    smallest_segment: int = 1_000_000

    def most_cuts(self, rows: int) -> int:
        """More cuts than a sample of so many rows can be expected to give."""
        return 2 * min(
            self.sample_rows // self.sample_rows_per_segment, rows // self.smallest_segment
        ) + 16


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Equal keys, NULL equal to NULL, where the right side's names have a prefix."""
    return reduce(
        lambda a, b: a & b, [left[key].eqNullSafe(right[f"{prefix}{key}"]) for key in keys]
    )


def hashable(df: DataFrame) -> list[str]:
    """The columns that can be hashed: all without maps and variants."""
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    return [name for name, kind in kinds.items() if "map<" not in kind and "variant" not in kind]


def fixed_width(schema: T.DataType) -> bool:
    """Whether the width of a value does not depend on its content."""
    if isinstance(schema, T.StructType):
        return all(fixed_width(field.dataType) for field in schema.fields)
    return isinstance(schema, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType))


def hash_sample(df: DataFrame, columns: Sequence[str], stride: int) -> DataFrame:
    """About one row in ``stride``, always the same ones for the same values."""
    return df.filter(F.pmod(F.xxhash64(*columns), F.lit(stride)) == 0)


def cut_points(
    places: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, cutting: Cutting
) -> DataFrame:
    """The places at which the segments of keys with many rows begin, numbered from 1."""
    stride = max(1, math.ceil(rows / cutting.sample_rows))
    per_segment = max(
        cutting.sample_rows_per_segment, math.ceil(cutting.smallest_segment / stride)
    )
    sample = hash_sample(
        places.select(*keys, F.struct(*order).alias(_PLACE)), [*keys, _PLACE], stride
    ).distinct()
    ranked = sample.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(_PLACE))
    )
    return ranked.filter(F.col(_RANK) % per_segment == 0).select(
        *[F.col(key).alias(f"_cut_{key}") for key in keys],
        _PLACE,
        F.floor(F.col(_RANK) / per_segment).cast("int").alias(_NUMBER),
    )


def _add_reached(df: DataFrame, cuts: str, most: int, into: str) -> DataFrame:
    """Add how many of the sorted cuts lie at or before the row's place, by halving steps.

    Each step is a projection of its own, which keeps the search in compiled code.
    """
    others = [name for name in df.columns if name != into]
    found = df.select(*others, F.lit(0).alias(into))
    for step in [2**i for i in reversed(range(most.bit_length()))]:
        reaches = F.get(F.col(cuts), F.col(into) + (step - 1)) <= F.col(_PLACE)
        found = found.select(
            *others, F.when(reaches, F.col(into) + step).otherwise(F.col(into)).alias(into)
        )
    return found


def add_segments(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cutting: Cutting = Cutting(),
    cut_from: DataFrame | None = None,
) -> DataFrame:
    """Add the segment number of each row within its key, and how often the key was cut.

    ``order`` must tell all rows of a key apart, else equal rows stay together.
    ``cut_from`` may name a table with the same keys and order that is cheaper to read than
    ``df``. Its rows are counted first; a table of one segment needs no cuts.

    The cuts of a key are searched in two steps, first among every n-th and then among the
    n between two of those, so that no row is joined with a long array.
    """
    places = df if cut_from is None else cut_from
    rows = places.count()
    if rows <= cutting.smallest_segment:
        return df.withColumn(SEGMENT, F.lit(0)).withColumn(CUTS_OF_KEY, F.lit(0))
    most = cutting.most_cuts(rows)
    step = math.isqrt(most) + 1
    cuts = saved_table(cut_points(places, keys, order, rows, cutting), "cuts")
    cut_keys = [f"_cut_{key}" for key in keys]
    every_nth = F.when(F.col(_NUMBER) % step == 0, F.col(_PLACE))
    coarse = cuts.groupBy(*cut_keys).agg(
        F.sort_array(F.collect_list(every_nth)).alias(_COARSE),
        F.count("*").cast("int").alias(CUTS_OF_KEY),
    )
    fine = cuts.groupBy(
        *cut_keys, F.floor(F.col(_NUMBER) / step).cast("int").alias(f"_cut_{_GROUP}")
    ).agg(F.sort_array(F.collect_list(_PLACE)).alias(_FINE))

    grouped = df.join(F.broadcast(coarse), same_keys(df, coarse, keys, "_cut_"), "left").select(
        *[df[name] for name in df.columns],
        F.struct(*[df[name] for name in order]).alias(_PLACE),
        F.coalesce(CUTS_OF_KEY, F.lit(0)).alias(CUTS_OF_KEY),
        _COARSE,
    )
    grouped = _add_reached(grouped, _COARSE, most // step + 1, _GROUP).drop(_COARSE)
    on = same_keys(grouped, fine, [*keys, _GROUP], "_cut_")
    searched = grouped.join(F.broadcast(fine), on, "left").select(*grouped.columns, _FINE)
    before = F.greatest(F.col(_GROUP) * step - 1, F.lit(0))
    return _add_reached(searched, _FINE, step, SEGMENT).select(
        *df.columns, (before + F.col(SEGMENT)).alias(SEGMENT), CUTS_OF_KEY
    )


def segment_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """The rows of a segment up to the current one."""
    return (
        Window.partitionBy(*keys, SEGMENT)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def earlier_segments(keys: Sequence[str]) -> WindowSpec:
    """The segments of a key before the current one, over one row per segment."""
    return (
        Window.partitionBy(*keys)
        .orderBy(SEGMENT)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def join_per_segment(df: DataFrame, per_segment: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of a table with one row per segment of the keys that were cut.

    Its rows are bounded by the cuts. If texts or the like are among its columns their bytes
    aren't, so adaptive execution decides, by what it has measured, whether to broadcast it.
    """
    renamed = per_segment.select(
        *[F.col(name).alias(f"_seg_{name}") if name in (*keys, SEGMENT) else F.col(name)
          for name in per_segment.columns]
    )
    on = same_keys(df, renamed, [*keys, SEGMENT], "_seg_")
    bounded = F.broadcast(renamed) if fixed_width(renamed.schema) else renamed
    return df.join(bounded, on, "left").drop(
        *[f"_seg_{name}" for name in (*keys, SEGMENT)]
    )


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    item: str,
    into: str,
    cutting: Cutting = Cutting(),
    cut_from: DataFrame | None = None,
) -> DataFrame:
    """Add the last value of ``item`` that is not NULL at or before each row of its key."""
    cut = add_segments(df, keys, order, cutting, cut_from)
    closing = (
        cut.filter((F.col(CUTS_OF_KEY) > 0) & F.col(item).isNotNull())
        .groupBy(*keys, SEGMENT, CUTS_OF_KEY)
        .agg(F.max_by(item, F.struct(*order)).alias("_carried"))
    )
    following = F.lead(SEGMENT).over(Window.partitionBy(*keys).orderBy(SEGMENT))
    later = F.when(
        F.col(SEGMENT) < F.col(CUTS_OF_KEY), F.sequence(F.col(SEGMENT) + 1, F.col("_until"))
    )
    carried = closing.withColumn("_until", F.coalesce(following, CUTS_OF_KEY)).select(
        *keys, F.explode(later).alias(SEGMENT), "_carried"
    )
    inside = cut.withColumn(
        into, F.last(item, ignorenulls=True).over(segment_window(keys, order))
    )
    return (
        join_per_segment(inside, carried, keys)
        .withColumn(into, F.coalesce(into, "_carried"))
        .drop("_carried", SEGMENT, CUTS_OF_KEY)
    )
