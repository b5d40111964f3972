"""Joins of time ranges that overlap, without comparing all with all.

Time is cut into bins of equal width and each range is written into every bin that it
touches, so overlapping ranges of a key share a bin and the join is an equi-join on key and
bin. A pair that shares several bins is given in the first one only. Bins in which very many
ranges lie are split like the hot keys of any other join.

Ranges are half-open, from ``start`` until before ``end``; an empty range, or one without a
start or end, overlaps nothing. The width should be about the length of a usual range: a
range of n widths is written n + 1 times, and ranges that only share a bin are compared in
vain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.lookups import Salting
from daybook.operators.skewed_joins import skewed_join

_BIN = "_bin"


def _binned(df: DataFrame, start: str, end: str, width: int, first: str) -> DataFrame:
    """One row per bin that the range touches, with its first bin."""

    def bin_of(value: Column) -> Column:
        return F.floor(value / width).cast("bigint")

    real = df.filter(F.col(start) < F.col(end))
    bins = F.sequence(bin_of(F.col(start)), bin_of(F.col(end) - 1))
    return real.select("*", bin_of(F.col(start)).alias(first), F.explode(bins).alias(_BIN))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    width: int,
    salting: Salting = Salting(),
) -> DataFrame:
    """All pairs of rows with equal keys whose ranges overlap, each once.

    Starts and ends are whole numbers, such as seconds; both sides share no names but the
    keys, and may have none of these.
    """
    (a, b), (c, d) = left_range, right_range
    one = _binned(left, a, b, width, "_left_first")
    other = _binned(right, c, d, width, "_right_first")
    pairs = skewed_join(one, other, [*keys, _BIN], "inner", salting)
    overlapping = (F.col(a) < F.col(d)) & (F.col(c) < F.col(b))
    once = F.col(_BIN) == F.greatest("_left_first", "_right_first")
    return pairs.filter(once & overlapping).drop(_BIN, "_left_first", "_right_first")
