"""Lookups: at most one match per row, and no row is lost."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.choices import lookup_status
from daybook.functions.numbers import fixed_decimals
from daybook.operators.segments import (
    Cutting,
    carry_last,
    fixed_width,
    hash_sample,
    hashable,
    same_keys,
)
from daybook.session import saved_table

BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 32 << 20
WIDEST_FIXED = 16

_SALT = "_salt"
_SALTS = "_salts"


@dataclass(frozen=True)
class Salting:
    """Which keys are hot: about ``sample_rows`` rows are looked at, and a key is split into
    one part per ``sample_rows_per_part`` of them. Tables of at most ``smallest_table`` rows
    are left alone.
    """

    sample_rows: int = 200_000
    sample_rows_per_part: int = 100
    smallest_table: int = 1_000_000


def fits_broadcast(
    df: DataFrame,
    rows: int = BROADCAST_ROWS,
    size: int = BROADCAST_BYTES,
    count_from: DataFrame | None = None,
) -> bool:
    """Whether a table has at most that many rows and bytes, as text.

    Counting Parquet reads only its footers; the bytes are added up only if the rows are few.
    ``count_from`` may name a table that is cheaper to count and has no fewer rows. The bytes
    are those of ``df`` itself; where no column's width depends on its content, the rows tell
    enough.
    """
    if (df if count_from is None else count_from).count() > rows:
        return False
    if fixed_width(df.schema) and rows * len(df.columns) * WIDEST_FIXED <= size:
        return True
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    return (df.agg(F.sum(width)).first()[0] or 0) <= size


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int, salting: Salting) -> DataFrame:
    """Keys with many rows in a sample, and the number of parts to split each into.

    Their number, and that of all parts, is bounded by the sample.
    """
    stride = max(1, math.ceil(rows / salting.sample_rows))
    counted = (
        hash_sample(df, hashable(df), stride)
        .groupBy(*[F.col(key).alias(f"_hot_{key}") for key in keys])
        .agg(F.ceil(F.count("*") / salting.sample_rows_per_part).cast("int").alias(_SALTS))
    )
    return counted.filter(F.col(_SALTS) > 1)


def _salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame
) -> DataFrame:
    salts = F.coalesce(_SALTS, F.lit(1))
    content = F.xxhash64(*[left[name] for name in hashable(left)])
    many = left.join(F.broadcast(hot), same_keys(left, hot, keys, "_hot_"), "left").select(
        *[left[name] for name in left.columns],
        F.pmod(content, salts).cast("int").alias(_SALT),
    )
    few = right.join(F.broadcast(hot), same_keys(right, hot, keys, "_hot_"), "left").select(
        *[
            right[name].alias(f"_right_{name}") if name in keys else right[name]
            for name in right.columns
        ],
        F.explode(F.sequence(F.lit(0), salts - 1)).alias(f"_right_{_SALT}"),
    )
    matched = many.join(few, [many[k] == few[f"_right_{k}"] for k in (*keys, _SALT)], "left")
    others = [name for name in left.columns if name not in keys]
    added = [name for name in right.columns if name not in keys]
    return matched.select(
        *[many[name] for name in (*keys, *others)], *[few[name] for name in added]
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    salting: Salting = Salting(),
    size_from: DataFrame | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Left join with a table that has at most one row per key.

    A right side of checked size is broadcast. A larger one is joined by shuffle, with the
    hot keys of the left side split over several tasks. ``broadcast_rows=0`` skips the check.
    ``size_from`` may name a table that is cheaper to count and has no fewer rows than
    ``right``; ``hot_from`` one with the same keys that is cheaper to read than ``left``.
    The rows of ``left`` and ``hot_from`` should differ in some column.
    """
    if broadcast_rows and fits_broadcast(right, broadcast_rows, count_from=size_from):
        return left.join(F.broadcast(right), list(keys), "left")
    sampled = left if hot_from is None else hot_from
    rows = sampled.count()
    if rows <= salting.smallest_table:
        return left.join(right, list(keys), "left")
    hot = saved_table(hot_keys(sampled, keys, rows, salting), "hot-keys")
    return _salted_join(left, right, keys, hot)


def label_lookup(
    rows: DataFrame, code: str, dimension: DataFrame, dimension_code: str, label: str, into: str
) -> DataFrame:
    """Add the label of a code; NULL where the dimension lacks the code.

    Of a code that the dimension has several times the first label by order counts.
    """
    labels = dimension.groupBy(F.col(dimension_code).alias(code)).agg(F.min(label).alias(into))
    return lookup_join(rows, labels, [code], size_from=dimension.select(dimension_code, label))


def best_candidate(
    candidates: DataFrame, keys: Sequence[str], rank: Sequence[Column], into: str = "match"
) -> DataFrame:
    """Per key the candidate with the lowest rank, as one struct column.

    Ranks compare in the given order; a NULL rank comes last.
    """
    values = [name for name in candidates.columns if name not in keys]
    order = F.struct(*[part for column in rank for part in (column.isNull(), column)])
    return candidates.groupBy(*keys).agg(F.min_by(F.struct(*values), order).alias(into))


def first_match(
    rows: DataFrame,
    candidates: DataFrame,
    keys: Sequence[str],
    rank: Sequence[Column],
    into: str = "match",
    broadcast_rows: int = 0,
) -> DataFrame:
    """Add the best candidate of each row's key; NULL where there is none.

    The candidates shrink to one per key before the join, partly before the shuffle.
    """
    best = best_candidate(candidates, keys, rank, into)
    return lookup_join(rows, best, keys, broadcast_rows)


def current_value(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    is_observation: Column,
    values: Sequence[str],
    into: str = "current",
    cutting: Cutting = Cutting(),
    cut_from: DataFrame | None = None,
) -> DataFrame:
    """Add the latest observation at or before each row of the same table.

    The observation is a struct; it is NULL where there is none, and may hold NULLs.
    """
    marked = rows.withColumn("_item", F.when(is_observation, F.struct(*values)))
    return carry_last(marked, keys, order, "_item", into, cutting, cut_from).drop("_item")


def as_of_lookup(
    rows: DataFrame,
    observations: DataFrame,
    keys: Sequence[str],
    time: str,
    row_id: str,
    observation_id: str,
    values: Sequence[str],
    into: str = "current",
    cutting: Cutting = Cutting(),
) -> DataFrame:
    """Add the latest observation of another table at or before each row's time.

    An observation with the same time counts as earlier. Keys and time have the same names
    in both tables; ``row_id`` and ``observation_id`` break ties.
    """
    item_type = observations.select(F.struct(*values).alias("_item")).schema["_item"].dataType
    id_type = observations.schema[observation_id].dataType
    left = rows.select(
        *keys,
        time,
        F.lit(1).alias("_side"),
        F.lit(None).cast(id_type).alias("_observation_id"),
        F.col(row_id).alias("_row_id"),
        F.struct(*[name for name in rows.columns if name not in (*keys, time)]).alias("_row"),
        F.lit(None).cast(item_type).alias("_item"),
    )
    right = observations.select(
        *keys,
        time,
        F.lit(0).alias("_side"),
        F.col(observation_id).alias("_observation_id"),
        F.lit(None).cast(left.schema["_row_id"].dataType).alias("_row_id"),
        F.lit(None).cast(left.schema["_row"].dataType).alias("_row"),
        F.struct(*values).alias("_item"),
    )
    order = [time, "_side", "_observation_id", "_row_id"]
    carried = carry_last(left.unionByName(right), keys, order, "_item", into, cutting)
    return carried.filter(F.col("_side") == 1).select(*keys, time, "_row.*", into)


def with_status(
    rows: DataFrame, place: str, observation: str, temperature: str, latitude: str, longitude: str
) -> DataFrame:
    """Add status and coordinate texts after the lookups; every row stays."""
    return rows.select(
        "*",
        lookup_status(F.col(place), F.col(observation), F.col(temperature)).alias("status"),
        fixed_decimals(F.col(latitude)).alias("latitude_text"),
        fixed_decimals(F.col(longitude)).alias("longitude_text"),
    )
