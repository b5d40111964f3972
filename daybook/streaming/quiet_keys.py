"""The latest choice per key with a state that quiet keys leave.

The state of a key is only a filter: a change that is older than what the key already has need
not be saved again. It lives for a time after the key's last change and is then dropped by the
state store. Nothing is lost by that, since each change that was newer has been saved, and
saved changes are folded into snapshots: if a key comes back, even with an old row, the
snapshot still holds its latest choice and the order decides. So the state holds the keys that
changed of late and the snapshot all of them.

The state store is RocksDB, which keeps states on disk and hands changes to the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from daybook.operators.latest import latest_value
from daybook.streaming.choices import run_batches
from daybook.streaming.folds import FOLD_EVERY, FoldedChanges

LIFE_SECONDS = 24 * 3600
# A query with time to live asks for one more batch without end, so batches without rows are off.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def state_settings(spark: SparkSession):
    """The settings that these queries start with; they are put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class LastChoice(StatefulProcessor):
    """Hands on a key's row if it is newer than the one that the state remembers.

    ``place`` is a column that orders the rows of a key as numbers or texts do.
    """

    def __init__(self, place: T.StructType, names: Sequence[str], life_seconds: int):
        self.place = place
        self.names = list(names)
        self.life_seconds = life_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", self.place, self.life_seconds * 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, best_place = None, self.latest.get() if self.latest.exists() else None
        for frame in rows:
            # Names that begin with an underscore don't reach here.
            frame.columns = [*self.names, *self.place.names]
            places = list(zip(*(frame[name] for name in self.place.names)))
            for at, place in enumerate(places):
                if best_place is None or place > tuple(best_place):
                    best, best_place = frame.iloc[at : at + 1], place
        if best is not None:
            self.latest.update(tuple(best_place))
            yield best[self.names]

    def close(self) -> None:
        pass


def run_latest_choice_of_active_keys(
    changes: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    folder: str,
    life_seconds: int = LIFE_SECONDS,
    fold_every: int = FOLD_EVERY,
) -> tuple[DataFrame, int]:
    """Take in what has arrived; the latest values per key, and the rows left in the state.

    ``order`` must hold whole numbers, texts or times without NULLs; times are compared to the
    microsecond. ``folder`` must be shared storage; a further run goes on where the last one
    stopped.
    """
    kept = [*values, *[name for name in order if name not in values]]
    names = [*keys, *kept]
    kinds = changes.select(*names).schema
    times = [name for name in order if isinstance(kinds[name].dataType, (T.TimestampType, T.TimestampNTZType))]
    places = [f"_place_{i}" for i in range(len(order))]
    numbered = changes.select(
        *names,
        *[
            (F.unix_micros(F.col(name).cast("timestamp")) if name in times else F.col(name)).alias(place)
            for name, place in zip(order, places)
        ],
    )
    state = T.StructType([T.StructField(place, numbered.schema[place].dataType) for place in places])
    store = FoldedChanges(
        changes.sparkSession,
        folder,
        kinds,
        lambda rows: latest_value(rows, keys, kept, order),
        fold_every,
    )
    newer = numbered.groupBy(*keys).transformWithStateInPandas(
        LastChoice(state, names, life_seconds), kinds, "Update", "ProcessingTime"
    )
    with state_settings(changes.sparkSession):
        query = run_batches(newer, "update", store.save, folder)
    progress = query.lastProgress
    held = sum(operator.numRowsTotal for operator in progress.stateOperators) if progress else 0
    return store.read().select(*keys, *values), held
