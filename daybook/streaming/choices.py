"""Streams of changes: the latest choice per key, and enrichment with fixed tables.

Rows may arrive in any order: the event time decides which choice is the latest, so a late
row never overwrites a newer one. There is no watermark, because it would drop late rows
and forget the choices of quiet keys. ``quiet_keys.py`` bounds the state without a loss,
``windows.py`` has windows with a watermark and a table of late rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daybook.operators.latest import latest_value
from daybook.streaming.folds import FOLD_EVERY, FoldedChanges, read_or_none


def change_events(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over Parquet files; ``path`` is a folder or a pattern of files."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_batches(
    rows: DataFrame, mode: str, save: Callable[[DataFrame, int], None], folder: str
) -> StreamingQuery:
    """Take in what has arrived, batch by batch."""
    query = (
        rows.writeStream.outputMode(mode)
        .foreachBatch(save)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_latest_choice(
    changes: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    folder: str,
    fold_every: int = FOLD_EVERY,
) -> DataFrame:
    """Take in what has arrived and give the latest values per key.

    The state holds one row per key. Each batch saves only the keys that changed, under its
    own number, so a repeated batch replaces itself; saved batches are folded into snapshots.
    ``folder`` must be shared storage; a further run with the same folder goes on where the
    last one stopped.
    """
    kept = [*values, *[name for name in order if name not in values]]
    latest = latest_value(changes, keys, kept, order)
    store = FoldedChanges(
        changes.sparkSession,
        folder,
        latest.schema,
        lambda rows: latest_value(rows, keys, kept, order),
        fold_every,
    )
    run_batches(latest, "update", store.save, folder)
    return store.read().select(*keys, *values)


def run_enriched(
    changes: DataFrame, enrich: Callable[[DataFrame], DataFrame], folder: str
) -> DataFrame:
    """Take in what has arrived, enrich it batch by batch, and give all that is there.

    ``enrich`` gets each batch as a table, so its lookups can check sizes and split hot keys
    like those of any other table.
    """

    def save(batch: DataFrame, number: int) -> None:
        enrich(batch).write.mode("overwrite").parquet(f"{folder}/batches/batch={number}")

    run_batches(changes, "append", save, folder)
    spark = changes.sparkSession
    schema = enrich(spark.createDataFrame([], changes.schema)).schema
    saved = read_or_none(spark, f"{folder}/batches", schema)
    return spark.createDataFrame([], schema) if saved is None else saved.drop("batch")
