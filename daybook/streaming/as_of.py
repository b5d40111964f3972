"""The latest observation at or before each row, where both come as streams.

A row and an observation meet in a stream-stream join: equal keys, and an observation that is
not later than the row and not older than a horizon. Both streams have watermarks, so the
state holds rows and observations only as long as a partner may still come. A row without any
observation comes out, alone, once the watermark has passed it.

A row may meet several observations, in different batches. Each batch saves the latest one
for each row, and the saved batches are folded: per row the latest observation stays.

Rows that come after the watermark are dropped by the join; where they must not be lost, send
the stream through the gate of ``windows.py`` first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.streaming.choices import run_batches
from daybook.streaming.folds import FOLD_EVERY, FoldedChanges


def run_as_of(
    rows: DataFrame,
    observations: DataFrame,
    keys: Sequence[str],
    time: str,
    row_id: str,
    observation_id: str,
    values: Sequence[str],
    horizon: str,
    delay: str,
    folder: str,
    fold_every: int = FOLD_EVERY,
) -> DataFrame:
    """Take in what has arrived; each row with its latest observation, a struct or NULL.

    Keys and time have the same names on both sides; ``row_id`` tells rows apart, and
    ``observation_id`` decides among observations of one time. ``horizon`` and ``delay`` are
    intervals. ``folder`` must be shared storage; a further run goes on where the last one
    stopped.
    """
    names = rows.columns
    left = rows.withWatermark(time, delay).alias("a")
    right = observations.select(
        *[F.col(key).alias(f"_at_{key}") for key in keys],
        F.col(time).alias("_at_time"),
        F.struct(F.col(time).alias("_time"), F.col(observation_id).alias("_id"), *values).alias("_found"),
    ).withWatermark("_at_time", delay)
    same = [left[key] == right[f"_at_{key}"] for key in keys]
    near = (right["_at_time"] <= left[time]) & (
        right["_at_time"] >= left[time] - F.expr(f"INTERVAL {horizon}")
    )
    met = left.join(right, [*same, near], "left").select(*names, "_found")

    def latest(pairs: DataFrame) -> DataFrame:
        others = [F.first(name).alias(name) for name in names if name != row_id]
        return pairs.groupBy(row_id).agg(*others, F.max("_found").alias("_found")).select(*names, "_found")

    store = FoldedChanges(rows.sparkSession, folder, met.schema, latest, fold_every)
    run_batches(met, "append", lambda batch, number: store.save(latest(batch), number), folder)
    value = F.struct(*[F.col(f"_found.{name}").alias(name) for name in values])
    return store.read().select(*names, F.when(F.col("_found").isNotNull(), value).alias("observed"))
