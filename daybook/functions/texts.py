"""Text length as web forms count it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def form_length(text: Column) -> Column:
    """Length in UTF-16 units, with a line break counted once."""
    single_breaks = F.regexp_replace(text, "\r\n", "\n")
    return (F.octet_length(F.encode(single_breaks, "UTF-16BE")) / 2).cast("int")


def form_length_between(text: Column, low: int, high: int) -> Column:
    """True where the length is in the range; NULL stays NULL."""
    return form_length(text).between(low, high)
