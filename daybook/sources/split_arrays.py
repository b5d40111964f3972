"""Array files of any size and layout, read by byte ranges.

A file ``[{...}, {...}]``, with or without an assignment before it, may be one line of any
length. The text reader cuts it at each closing brace, so Spark deals its byte ranges to many
tasks and no range begins inside a character or an escape. What a brace means still depends
on all that stands before it:

1. Every range tells its transition: whether it turns outside of a string into inside, and by
   how much it changes the depth, for either way in which it may begin.
2. The transitions are composed in file order, as running sums over one short row per range.
   They give the state in which each range begins.
3. The ranges are read again from their state. A brace that closes an element of the array
   ends a record. Whole records leave at once; what a range holds of a record that crosses
   its ends is joined with its other parts.

Each range is read by one task, twice, and only the parts of crossing records are shuffled.
The table of states is broadcast; it has a row per range, some 200,000 for 100 TB in ranges
of 512 MB (``range_bytes``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daybook.session import shared_folder

RANGE_BYTES = 64 << 20
MOST_RANGES = 2_000_000
CLOSING = "}"
RAW = "raw"

_RANGE = ["file", "start"]
_ESCAPES = r"(?s)\\."
_STRING_FROM_OUTSIDE = r'(?s)"[^"]*(?:"|\z)'
_STRING_FROM_INSIDE = r'(?s)\A[^"]*(?:"|\z)'
_BEGINNING = r"^\s*(?:[A-Za-z_]\w*\s*=\s*)?\[\s*"
_BETWEEN = r"^\s*,\s*"
_ENDING = r"^\s*\]\s*$"
_NOTHING = r"^\s*(?:[A-Za-z_]\w*\s*=\s*)?\[\s*\]\s*$"


def pinned_session(spark: SparkSession, range_bytes: int) -> SparkSession:
    """A session like this one that always cuts files into ranges of the same size.

    The states of one read must fit the ranges of the next, also if executors come and go.
    """
    pinned = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            pinned.conf.set(name, value)
    pinned.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    pinned.conf.set("spark.sql.files.openCostInBytes", str(range_bytes))
    pinned.conf.set("spark.sql.files.minPartitionNum", "1")
    return pinned


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What stands before each closing brace, and after the last, in the order of its range."""
    return spark.read.option("lineSep", CLOSING).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def _quotes_and_depths(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of quotes of each piece, and its change of depth from outside and inside.

    The closing brace is not yet counted.
    """
    plain = pc.replace_substring_regex(values, _ESCAPES, "")
    outside = pc.replace_substring_regex(plain, _STRING_FROM_OUTSIDE, "")
    inside = pc.replace_substring_regex(
        pc.replace_substring_regex(plain, _STRING_FROM_INSIDE, ""), _STRING_FROM_OUTSIDE, ""
    )

    def change(text: pa.Array) -> np.ndarray:
        opened = pc.count_substring_regex(text, r"[\[{]").to_numpy(zero_copy_only=False)
        closed = pc.count_substring_regex(text, r"[\]}]").to_numpy(zero_copy_only=False)
        return opened.astype(np.int64) - closed

    quotes = pc.count_substring(plain, '"').to_numpy(zero_copy_only=False).astype(np.int64)
    return quotes, change(outside), change(inside)


def _run(
    quotes: np.ndarray, outside: np.ndarray, inside: np.ndarray, in_string: int, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """In a string or not, and the depth, after each piece and its closing brace."""
    after = (in_string + np.cumsum(quotes)) % 2
    before = np.concatenate([[in_string], after[:-1]])
    change = np.where(before == 1, inside, outside) - (after == 0)
    return after, depth + np.cumsum(change)


def _ranges_of(batch: pa.RecordBatch):
    """The rows of a batch, cut where another range begins."""
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    start = batch.column("start").to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    stops = [0, *cuts.tolist(), len(batch)]
    for one, other in zip(stops, stops[1:]):
        if one < other:
            part = batch.slice(one, other - one)
            yield (part.column("file")[0].as_py(), part.column("start")[0].as_py()), part


def _transitions(pieces: DataFrame) -> DataFrame:
    """(file, start, odd, outside, inside): what each range does to the state."""

    def run(batches):
        now, state = None, None

        def row():
            (file, start), (odd, outside, inside) = now, state
            names = ["file", "start", "odd", "outside", "inside"]
            return pa.RecordBatch.from_pylist(
                [dict(zip(names, (file, start, odd, outside, inside)))],
                pa.schema([("file", pa.string()), *((name, pa.int64()) for name in names[1:])]),
            )

        for batch in batches:
            for place, part in _ranges_of(batch):
                if place != now:
                    if now is not None:
                        yield row()
                    now, state = place, (0, 0, 0)
                odd, outside, inside = state
                given = _quotes_and_depths(part.column("value"))
                after, depth = _run(*given, odd, outside)
                state = (int(after[-1]), int(depth[-1]), int(_run(*given, 1 - odd, inside)[1][-1]))
        if now is not None:
            yield row()

    return pieces.mapInArrow(run, "file string, start bigint, odd bigint, outside bigint, inside bigint")



def range_states(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """(file, start, in_string, depth) at the beginning of each range.

    Fails if a file does not end outside of all strings and brackets. The transitions are
    computed once and kept in the shared folder.
    """
    path = shared_folder(spark, "array-ranges")
    _transitions(pieces).write.parquet(path)
    moves = spark.read.parquet(path)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    entered = moves.withColumn("in_string", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    changed = entered.withColumn(
        "change", F.when(F.col("in_string") == 1, F.col("inside")).otherwise(F.col("outside"))
    )
    states = changed.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    # The last piece has no brace of its own, so a closed array ends one below nothing.
    ends = states.groupBy("file").agg(
        (F.sum("odd") % 2 == 0).alias("outside"), (F.sum("change") == -1).alias("closed"), F.count("*").alias("ranges")
    )
    checked = ends.agg(
        F.coalesce(F.every(F.col("outside") & F.col("closed")), F.lit(True)), F.coalesce(F.sum("ranges"), F.lit(0))
    ).first()
    if not checked[0]:
        raise ValueError("malformed array file: an array or a text in it is not closed")
    if checked[1] > MOST_RANGES:
        raise ValueError(f"{checked[1]} ranges; ask for larger ones with range_bytes")
    return states.select(*_RANGE, "in_string", "depth")


def _parts(pieces: DataFrame) -> DataFrame:
    """(file, start, nr, begins, ends, text): whole records and parts of crossing ones."""
    kinds = pa.schema(
        [
            ("file", pa.string()),
            ("start", pa.int64()),
            ("nr", pa.int64()),
            ("begins", pa.bool_()),
            ("ends", pa.bool_()),
            ("text", pa.string()),
        ]
    )

    def run(batches):
        now = None
        held: list[str] = []
        in_string = depth = nr = 0
        begins = True

        def rest():
            if held:
                row = (now[0], now[1], nr, begins, False, "".join(held))
                yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, row))], kinds)

        for batch in batches:
            for place, part in _ranges_of(batch):
                if place != now:
                    yield from rest()
                    now, held, nr = place, [], 0
                    in_string, depth = (part.column(name)[0].as_py() for name in ("in_string", "depth"))
                    if in_string is None:
                        raise ValueError("the ranges of the files have changed, read them again")
                    begins = place[1] == 0 or (depth == 1 and in_string == 0)
                after, depths = _run(*_quotes_and_depths(part.column("value")), in_string, depth)
                in_string, depth = int(after[-1]), int(depths[-1])
                values = part.column("value").to_pylist()
                closed = np.flatnonzero((after == 0) & (depths == 1)).tolist()
                texts, first = [], 0
                for stop in closed:
                    if held or stop > first:
                        held.extend(value + CLOSING for value in values[first : stop + 1])
                        texts.append("".join(held))
                        held = []
                    else:
                        texts.append(values[stop] + CLOSING)
                    first = stop + 1
                held.extend(value + CLOSING for value in values[first:])
                if texts:
                    count = len(texts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([now[0]] * count, pa.string()),
                            pa.array([now[1]] * count, pa.int64()),
                            pa.array(range(nr, nr + count), pa.int64()),
                            pa.array([begins] + [True] * (count - 1)),
                            pa.array([True] * count),
                            pa.array(texts, pa.string()),
                        ],
                        schema=kinds,
                    )
                    nr, begins = nr + count, True
        yield from rest()

    return pieces.mapInArrow(
        run, "file string, start bigint, nr bigint, begins boolean, ends boolean, text string"
    )


def _joined_parts(crossing: DataFrame) -> DataFrame:
    """Records out of their parts in several ranges, and what closes each array."""
    in_order = Window.partitionBy("file").orderBy("start", "nr")
    numbered = crossing.withColumn("record", F.sum(F.col("begins").cast("long")).over(in_order))
    parts = F.sort_array(F.collect_list(F.struct("start", "nr", "text")))
    return numbered.groupBy("file", "record").agg(
        F.min("start").alias("start"),
        F.min_by("nr", F.struct("start", "nr")).alias("nr"),
        F.max("ends").alias("ends"),
        F.array_join(F.transform(parts, lambda part: part["text"]), "").alias("text"),
    )


def array_records(
    spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(file, raw): each record's own text. A broken file fails the read.

    Elements of the array must be objects. Compressed files can't be cut, so each of them is
    one range.
    """
    pieces = _pieces(pinned_session(spark, range_bytes), path)
    states = range_states(spark, pieces).withColumnsRenamed({name: f"at_{name}" for name in _RANGE})
    same = [pieces[name] == states[f"at_{name}"] for name in _RANGE]
    entered = pieces.join(F.broadcast(states), same, "left").select(
        *_RANGE, "in_string", "depth", "value"
    )
    parts = _parts(entered)
    whole = parts.filter("begins AND ends").select("file", "start", "nr", "text")
    crossing = parts.filter("NOT (begins AND ends)")
    joined = _joined_parts(crossing)
    # What follows the last record has the brace that the array lacks.
    left = F.substring("text", F.lit(1), F.length("text") - 1)
    closing = left.rlike(_ENDING) | ((F.col("start") == 0) & (F.col("nr") == 0) & left.rlike(_NOTHING))
    checked = joined.filter(
        F.when(F.col("ends"), F.lit(True)).otherwise(
            F.when(closing, F.lit(False)).otherwise(
                F.raise_error(F.lit("malformed array file: something follows the last record")).cast("boolean")
            )
        )
    )
    records = whole.unionByName(checked.select("file", "start", "nr", "text"))
    first = (F.col("start") == 0) & (F.col("nr") == 0)
    before = F.when(first, F.regexp_extract("text", _BEGINNING, 0)).otherwise(
        F.regexp_extract("text", _BETWEEN, 0)
    )
    broken = F.raise_error(F.lit("malformed array file: no comma or bracket before a record"))
    body = F.when(before == "", broken.cast("string")).otherwise(
        F.substring("text", F.length(before) + 1, F.length("text"))
    )
    return records.select("file", body.alias(RAW))


def read_split_array(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The records of array files of any size and layout. A broken file fails the read."""
    record = F.from_json(RAW, schema, {"mode": "FAILFAST"})
    return array_records(spark, path, range_bytes).select(record.alias("record")).select("record.*")


def read_split_raw_records(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The same with each record's own text; a value of the wrong kind becomes NULL."""
    records = array_records(spark, path, range_bytes)
    return records.select(F.from_json(RAW, schema).alias("record"), RAW).select("record.*", RAW)
