"""Event-time windows over a stream, with a watermark and a table of late rows.

A watermark lets the state forget windows that are over, and Spark then drops rows that come
too late without a trace. Here the stream first passes a gate: a row whose time is not after
the watermark, that is the largest time of all earlier batches less the delay, or has none,
is written to a table of late rows, all others to a table of rows on time. Both together are
the input. The windows are computed from the rows on time, as a stream with a watermark of
the same delay: as it takes in whole batches of the gate, it never meets a row that it would
drop. A window is given once, when the watermark has passed its end.

The gate remembers one time per batch; the windows' state holds the open windows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.streaming.choices import run_batches
from daybook.streaming.folds import read_or_none

_MARK = T.StructType([T.StructField("latest", T.TimestampType())])


def run_gate(rows: DataFrame, time: str, delay: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """Take in what has arrived; the rows on time and the late ones of all runs.

    ``time`` must be a timestamp, ``delay`` an interval such as ``10 minutes``. A repeated
    batch replaces itself.
    """
    spark = rows.sparkSession

    def path(kind: str, number: int) -> str:
        return f"{folder}/{kind}/batch={number}"

    def save(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        earlier = read_or_none(spark, path("marks", number - 1), _MARK) if number else None
        latest = earlier.first().latest if earlier is not None else None
        late = F.col(time).isNull()
        if latest is not None:
            late = late | (F.col(time) <= F.lit(latest) - F.expr(f"INTERVAL {delay}"))
        held.filter(late).write.mode("overwrite").parquet(path("late", number))
        held.filter(~late).write.mode("overwrite").parquet(path("on-time", number))
        largest = held.agg(F.greatest(F.max(time), F.lit(latest).cast("timestamp")).alias("latest"))
        largest.write.mode("overwrite").parquet(path("marks", number))
        held.unpersist()

    run_batches(rows, "append", save, f"{folder}/gate")
    tables = [read_or_none(spark, f"{folder}/{kind}", rows.schema) for kind in ("on-time", "late")]
    empty = spark.createDataFrame([], rows.schema)
    return tuple(empty if table is None else table.select(*rows.columns) for table in tables)


def run_windows(
    rows: DataFrame,
    time: str,
    delay: str,
    window: Column,
    keys: Sequence[str],
    measures: Sequence[Column],
    folder: str,
) -> tuple[DataFrame, DataFrame]:
    """Take in what has arrived; all windows that are over, and the late rows.

    ``window`` is ``F.window`` (tumbling or sliding) or ``F.session_window`` over ``time``.
    """
    spark = rows.sparkSession
    on_time, late = run_gate(rows, time, delay, folder)
    on_time.limit(0).write.mode("ignore").parquet(f"{folder}/on-time/batch=-1")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/on-time/*")
    over = (
        stream.withWatermark(time, delay)
        .groupBy(window.alias("window"), *keys)
        .agg(*measures)
        .select("window.start", "window.end", F.expr("* EXCEPT (window)"))
    )

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/windows/batch={number}")

    run_batches(over, "append", save, f"{folder}/over")
    found = read_or_none(spark, f"{folder}/windows", over.schema)
    return (spark.createDataFrame([], over.schema) if found is None else found.select(*over.columns)), late
