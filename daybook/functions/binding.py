"""A value that an expression uses several times, computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body applied to the value.

    Inside array functions a repeated expression is computed again for each use; a bound
    value is not.
    """
    return F.get(F.transform(F.array(value), body), 0)
