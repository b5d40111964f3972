"""A store of changes that stays cheap to read: a snapshot and the changes after it.

Batches are saved under their own number, in generations of ``fold_every`` batches. The first
batch of a generation first folds the one before: its changes and the snapshot so far become
the next snapshot, under a new name. Then a manifest names that snapshot and the generation
from which on changes must still be read. There are two places for the manifest, used in
turn; while one is written the other one stays, and a reader takes the later one it finds.

Nothing is changed or deleted that a reader may need. A fold that breaks leaves a snapshot
that no manifest names; a fold or batch that is repeated gives the same rows once more, and
the latest value per key is the same with a row given twice. So a reader always sees one
whole snapshot and every later change, and opens at most one snapshot and ``fold_every``
batches, or twice as many while a fold is going on.

Folded generations and older snapshots are of no more use once no reader holds them; a rule of
the storage may remove them by age.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLD_EVERY = 32
_PLACES = 2


def read_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at a path, or None if nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class FoldedChanges:
    """Changes below a folder of shared storage, one writer at a time.

    ``fold`` must give the same rows however often a change is in its input.
    """

    _MANIFEST = T.StructType(
        [T.StructField("generation", T.LongType()), T.StructField("snapshot", T.StringType())]
    )

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        fold: Callable[[DataFrame], DataFrame],
        fold_every: int = FOLD_EVERY,
    ):
        self.spark = spark
        self.folder = folder
        self.schema = schema
        self.fold = fold
        self.fold_every = fold_every

    def _generation(self, number: int) -> str:
        return f"{self.folder}/changes/generation={number}"

    def _manifest(self) -> tuple[int, str | None]:
        """The first generation to be read, and the snapshot before it."""
        found = []
        for place in range(_PLACES):
            rows = read_or_none(self.spark, f"{self.folder}/manifest-{place}", self._MANIFEST)
            # A place that is being written may be there without any row.
            row = rows.agg(F.max(F.struct("generation", "snapshot"))).first()[0] if rows else None
            if row is not None:
                found.append((row.generation, row.snapshot))
        return max(found, default=(0, None))

    def _tables(self, generation: int, snapshot: str | None, until: int) -> list[DataFrame]:
        paths = [] if snapshot is None else [snapshot]
        paths += [self._generation(number) for number in range(generation, until + 1)]
        tables = [read_or_none(self.spark, path, self.schema) for path in paths]
        return [table.select(*self.schema.names) for table in tables if table is not None]

    def _union(self, tables: list[DataFrame]) -> DataFrame:
        rows = self.spark.createDataFrame([], self.schema)
        for table in tables:
            rows = rows.unionByName(table)
        return rows

    def _fold_before(self, generation: int) -> None:
        first, snapshot = self._manifest()
        if first >= generation:
            return
        path = f"{self.folder}/snapshots/{generation}-{uuid.uuid4().hex}"
        tables = self._tables(first, snapshot, generation - 1)
        self.fold(self._union(tables)).write.parquet(path)
        row = self.spark.createDataFrame([(generation, path)], self._MANIFEST).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.folder}/manifest-{generation % _PLACES}")

    def save(self, batch: DataFrame, number: int) -> None:
        """Save a batch under its number; a repeated batch replaces itself."""
        generation = number // self.fold_every
        if generation and number % self.fold_every == 0:
            self._fold_before(generation)
        path = f"{self._generation(generation)}/batch={number}"
        batch.select(*self.schema.names).write.mode("overwrite").parquet(path)

    def read(self) -> DataFrame:
        """The latest rows: one snapshot and all later changes."""
        first, snapshot = self._manifest()
        # The writer may have gone on to the next generation meanwhile.
        return self.fold(self._union(self._tables(first, snapshot, first + 1)))
