"""Repeated passages, by sorting the windows of all documents one bucket at a time.

A byte is removed if a window of ``WIDTH`` bytes that covers it also starts in a document
with a smaller id. Equal windows are found by blockwise suffix sorting. Its sample of
positions, the cover, must meet any two equal windows at the same distance from their
starts. Here the cover is defined by content: the position in a window with the smallest
hashed gram of ``GRAM`` bytes. Equal windows have it at the same place, and it takes about 7
in 100 positions, where a cover by position needs 19 or more.

Neighbouring windows with the same cover position form a run. The work has three rounds:

1. Each chunk of documents sends the names of its runs' grams to buckets. A bucket sorts
   them and tells each chunk which grams occur in other documents too.
2. The chunk sends only those runs, each different text once, with the smallest id that has
   it in the chunk. A bucket of runs is sorted on its own: windows that share their first
   bytes are told apart by their next ones, and what is still tied at the end is equal. The
   bucket tells each chunk which windows have a smaller id elsewhere.
3. The chunk puts the answers together per document.

A gram with more than ``HOT`` runs has too many texts around it for one bucket: its windows
go to buckets one by one, by a hash of their bytes. The same text costs one entry per chunk,
however often it occurs. Chunks and buckets have bounded sizes, a task holds one at a time,
and a chunk is saved before its first round, so that all rounds see the same.

Defined results: a null text is an empty one; in texts that are returned it stays null. Rows
with the same id are one document: they remove nothing from each other. Rows without an id
lose nothing and remove nothing. A very long text is a chunk of its own, up to the 2 GB of a
cell. Other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.saving import saved

WIDTH = 50
GRAM = 24
#: A chunk and a bucket hold so much of small inputs. As each chunk sends to each bucket, both
#: grow with the square root of larger ones, so that the number of messages at first grows with
#: the input and not with its square. The memory of a task ends that: a chunk gets no more than
#: four times as large, at 16 GB, and a bucket twice as large.
CHUNK = 4 << 20
BUCKET = 8 << 20
GROWN_FROM = 1 << 30
CHUNK_GROWTH, BUCKET_GROWTH = 4, 2
SMALL = 256
WINDOWS_AT_ONCE = 1 << 19
HOT = 4096
PLACE_BITS = np.uint64(20)
PLACES = np.uint64((1 << 20) - 1)
NAME_SHIFT = np.uint64(24)
UNSHARED, SHARED, HOT_GRAM = 0, 1, 2


def packed(values: np.ndarray) -> bytes:
    """An array in little space: its bytes by significance, compressed if that can pay."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    content = np.ascontiguousarray(planes).tobytes()
    return b"r" + content if len(content) <= SMALL else b"z" + zstandard.compress(content, 1)


def unpacked(content: bytes, kind: type) -> np.ndarray:
    plain = content[1:] if content[:1] == b"r" else zstandard.decompress(content[1:])
    planes = np.frombuffer(plain, np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number."""
    low = data.astype(np.uint64)
    for size in (1, 2, 4):
        low = low[:-size] | low[size:] << np.uint64(8 * size)
    return low


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the gram at each position."""
    eight = words(data)
    count = len(data) - GRAM + 1
    mixed = np.zeros(count, np.uint64)
    for start in range(0, GRAM, 8):
        mixed ^= eight[start : start + count]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same cover position: first window, number, hash of the gram.

    ``ends`` are the ends of the documents in ``data``; windows don't cross them.
    """
    found = []
    for low in range(0, len(data) - WIDTH + 1, WINDOWS_AT_ONCE):
        part = data[low : low + WINDOWS_AT_ONCE + WIDTH - 1]
        count = len(part) - WIDTH + 1
        crossing = np.zeros(count + 1, np.int32)
        cuts = ends[np.searchsorted(ends, low) : np.searchsorted(ends, low + len(part))] - low
        np.add.at(crossing, np.clip(cuts - WIDTH + 1, 0, count), 1)
        np.add.at(crossing, np.clip(cuts, 0, count), -1)
        inside = np.cumsum(crossing[:-1]) == 0
        hashes = gram_hashes(part)
        least = hashes & ~PLACES | np.arange(len(hashes), dtype=np.uint64)
        span, grams = 1, WIDTH - GRAM + 1
        while span < grams:
            step = min(span, grams - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        place = (least & PLACES).astype(np.int64)
        new = inside.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
        first = np.flatnonzero(new)
        if len(first):
            covered = np.concatenate([[0], np.cumsum(inside)])
            until = np.append(first[1:], count)
            found.append((first + low, covered[until] - covered[first], hashes[place[first]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


class Chunk:
    """The documents of a chunk and the runs of those that have an id."""

    def __init__(self, row: dict, buckets: int) -> None:
        self.buckets = buckets
        self.text = zstandard.decompress(row["texts"])
        self.data = np.frombuffer(self.text, np.uint8)
        self.sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        known = np.array([x is not None for x in row["ids"]], bool)
        self.ids = np.array([0 if x is None else x for x in row["ids"]], np.int64)
        first, count, gram = runs(self.data, self.ends)
        document = np.searchsorted(self.ends, first, side="right")
        usable = known[document] if len(document) else np.zeros(0, bool)
        self.first, self.count, self.gram = first[usable], count[usable], gram[usable]
        self.id = self.ids[document[usable]]
        names, self.name_of = np.unique(self.gram, return_inverse=True)
        # Names by bucket; within a bucket they ascend.
        self.order = np.argsort(names % np.uint64(buckets), kind="stable")
        self.names = names[self.order]
        self.cuts = np.searchsorted(self.names % np.uint64(buckets), np.arange(buckets + 1))

    def sent_names(self) -> Iterator[tuple]:
        """(bucket, names, counts, several) for each bucket."""
        if not len(self.names):
            return
        order = np.argsort(self.name_of, kind="stable")
        heads = np.searchsorted(self.name_of[order], np.arange(len(self.names)))
        ids = self.id[order]
        several = np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)
        counts = np.minimum(np.diff(np.append(heads, len(ids))), 65535).astype(np.uint16)
        several, counts = several[self.order].astype(np.uint8), counts[self.order]
        short = self.names >> NAME_SHIFT
        for bucket in np.flatnonzero(np.diff(self.cuts)).tolist():
            own = slice(self.cuts[bucket], self.cuts[bucket + 1])
            steps = np.diff(short[own], prepend=np.uint64(0))
            yield bucket, packed(steps), packed(counts[own]), packed(several[own])

    def records(self, answers: dict[int, bytes]) -> None:
        """Choose the different texts to send, from the states of the names by bucket.

        ``record_of`` says for each entry of ``places`` (a run, or a window of a hot gram)
        which record has its text.
        """
        states = np.zeros(len(self.names), np.uint8)
        for bucket, content in answers.items():
            states[self.cuts[bucket] : self.cuts[bucket + 1]] = unpacked(content, np.uint8)
        by_name = np.empty_like(states)
        by_name[self.order] = states
        state = by_name[self.name_of] if len(self.names) else states
        runs_shared, runs_hot = np.flatnonzero(state == SHARED), np.flatnonzero(state == HOT_GRAM)
        hot_count = self.count[runs_hot]
        inner = np.arange(hot_count.sum()) - np.repeat(np.cumsum(hot_count) - hot_count, hot_count)
        place = np.concatenate([self.first[runs_shared], np.repeat(self.first[runs_hot], hot_count) + inner])
        count = np.concatenate([self.count[runs_shared], np.ones(len(inner), np.int64)])
        ids = np.concatenate([self.id[runs_shared], np.repeat(self.id[runs_hot], hot_count)])
        bucket = np.concatenate(
            [
                (self.gram[runs_shared] % np.uint64(self.buckets)).astype(np.int64),
                np.full(len(inner), -1),
            ]
        )
        order = np.lexsort((place, ids))
        self.place, self.number, self.holder = place[order], count[order], ids[order]
        bucket = bucket[order]
        known: dict[bytes, int] = {}
        record_of, chosen = np.empty(len(order), np.int64), []
        stops = (self.place + self.number + WIDTH - 1).tolist()
        for i, (start, stop) in enumerate(zip(self.place.tolist(), stops)):
            content = self.text[start:stop]
            record = known.setdefault(content, len(chosen))
            if record == len(chosen):
                chosen.append(i)
                if bucket[i] < 0:
                    bucket[i] = xxhash.xxh3_64_intdigest(content) % self.buckets
            record_of[i] = record
        self.record_of = record_of
        self.chosen = np.array(chosen, np.int64)
        self.bucket = bucket[self.chosen] if chosen else np.zeros(0, np.int64)
        self.by_bucket = np.argsort(self.bucket, kind="stable")
        self.bucket_cuts = np.searchsorted(self.bucket[self.by_bucket], np.arange(self.buckets + 1))

    def sent_records(self) -> Iterator[tuple]:
        """(bucket, texts, numbers of windows, ids) for each bucket."""
        for bucket in np.flatnonzero(np.diff(self.bucket_cuts)).tolist():
            own = self.by_bucket[self.bucket_cuts[bucket] : self.bucket_cuts[bucket + 1]]
            entry = self.chosen[own]
            starts = self.place[entry].tolist()
            stops = (self.place[entry] + self.number[entry] + WIDTH - 1).tolist()
            content = b"".join([self.text[a:b] for a, b in zip(starts, stops)])
            yield (
                bucket,
                zstandard.compress(content, 1),
                packed(self.number[entry].astype(np.uint8)),
                packed(self.holder[entry]),
            )

    def removed(self, masks: dict[int, bytes]) -> np.ndarray:
        """Which bytes go, from the masks of the records by bucket."""
        mask = np.zeros(len(self.chosen), np.uint32)
        for bucket, content in masks.items():
            own = self.by_bucket[self.bucket_cuts[bucket] : self.bucket_cuts[bucket + 1]]
            mask[own] = unpacked(content, np.uint32)
        change = np.zeros(len(self.data) + 1, np.int32)
        if len(self.place):
            first_holder = self.holder[self.chosen[self.record_of]]
            all_windows = (np.uint64(1) << self.number.astype(np.uint64)) - np.uint64(1)
            own = np.where(self.holder > first_holder, all_windows, mask[self.record_of])
            for window in range(int(self.number.max())):
                starts = self.place[(own >> np.uint64(window) & np.uint64(1)).astype(bool)] + window
                np.add.at(change, starts, 1)
                np.add.at(change, starts + WIDTH, -1)
        return np.cumsum(change[:-1], dtype=np.int32) > 0


def equal_windows(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for each window, the same for equal ones.

    Windows are sorted by their first eight bytes. Those that are tied are sorted by their
    next eight, and so on; a window that is tied with no other is done.
    """
    eight = words(data)
    _, number = np.unique(eight[starts], return_inverse=True)
    tied = np.arange(len(starts))
    for offset in [*range(8, WIDTH - 8, 8), WIDTH - 8]:
        sizes = np.bincount(number[tied])
        tied = tied[sizes[number[tied]] > 1]
        if not len(tied):
            break
        group, following = number[tied], eight[starts[tied] + offset]
        order = np.lexsort((following, group))
        new = np.ones(len(order), bool)
        new[1:] = (group[order][1:] != group[order][:-1]) | (
            following[order][1:] != following[order][:-1]
        )
        # New numbers begin beyond all old ones, which stay with the windows that are done.
        number[tied[order]] = number.max() + np.cumsum(new)
    return np.unique(number, return_inverse=True)[1]


def states_of_names(rows: pa.Table, hot: int) -> list[bytes]:
    """For each chunk's names in a bucket, which of them occur in several documents."""
    names = [np.cumsum(unpacked(x, np.uint64)) for x in rows["names"].to_pylist()]
    sizes = [len(x) for x in names]
    counts = np.concatenate([unpacked(x, np.uint16) for x in rows["counts"].to_pylist()])
    several = np.concatenate([unpacked(x, np.uint8) for x in rows["several"].to_pylist()])
    every = np.concatenate(names)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    entries = np.diff(np.append(heads, len(ordered)))
    state = (entries > 1) | (np.maximum.reduceat(several[order], heads) > 0)
    total = np.add.reduceat(counts[order].astype(np.int64), heads)
    state = np.where(state, np.where(total > hot, HOT_GRAM, SHARED), UNSHARED).astype(np.uint8)
    states = np.empty(len(every), np.uint8)
    states[order] = np.repeat(state, entries)
    return [packed(np.ascontiguousarray(x)) for x in np.split(states, np.cumsum(sizes)[:-1])]


def masks_of_records(rows: pa.Table) -> list[bytes]:
    """For each chunk's records in a bucket, which windows have a smaller id elsewhere."""
    numbers = [unpacked(x, np.uint8) for x in rows["numbers"].to_pylist()]
    ids = np.concatenate([unpacked(x, np.int64) for x in rows["ids"].to_pylist()])
    number = np.concatenate(numbers).astype(np.int64)
    text_of: dict[bytes, int] = {}
    distinct = np.empty(len(number), np.int64)
    at = 0
    for content, of_chunk in zip(rows["texts"].to_pylist(), numbers):
        text = zstandard.decompress(content)
        stops = np.cumsum(of_chunk.astype(np.int64) + WIDTH - 1).tolist()
        start = 0
        for stop in stops:
            distinct[at] = text_of.setdefault(text[start:stop], len(text_of))
            start, at = stop, at + 1
    least = np.full(len(text_of), np.iinfo(np.int64).max)
    np.minimum.at(least, distinct, ids)
    data = np.frombuffer(b"".join(text_of) + bytes(8), np.uint8)
    sizes = np.array([len(x) for x in text_of], np.int64)
    windows = sizes - WIDTH + 1
    text_starts = np.cumsum(sizes) - sizes
    window_starts = np.cumsum(windows) - windows
    starts = np.arange(windows.sum()) + np.repeat(text_starts - window_starts, windows)
    same = equal_windows(data, starts)
    least_of = np.full(same.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least_of, same, np.repeat(least, windows))
    least_of = least_of[same]
    masks = np.zeros(len(number), np.uint32)
    for window in range(int(number.max())):
        some = np.flatnonzero(number > window)
        earlier = least_of[window_starts[distinct[some]] + window] < ids[some]
        masks[some] |= earlier.astype(np.uint32) << np.uint32(window)
    return [packed(x) for x in np.split(masks, np.cumsum([len(x) for x in numbers])[:-1])]


def null_name(docs: DataFrame) -> str:
    """A name that no column has, for whether the text is null."""
    return "_null_text" + "_" * max(map(len, docs.columns))


def chunks(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """Rows with many documents each: their ids, sizes, texts and other columns."""
    others = [name for name in docs.columns if name != "text"]
    rest = F.struct(*[docs[name] for name in others], docs["text"].isNull().alias(null_name(docs)))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, raw = TaskContext.get().partitionId() << 32, [], 0

        def out() -> pa.RecordBatch:
            ids = [x[0] for x in held]
            joined = pa.concat_arrays([x[2] for x in held])
            offsets = pa.array([0, len(joined)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([raw], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(x[1]) for x in held]], pa.list_(pa.int64())),
                    pa.array([zstandard.compress(b"".join([x[1] for x in held]), 3)]),
                    pa.ListArray.from_arrays(offsets, joined),
                ],
                ["chunk", "raw", "ids", "sizes", "texts", "rest"],
            )

        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py() or b""
                held.append((batch.column(0)[row].as_py(), text, batch.column(2).slice(row, 1)))
                raw += len(text)
                if raw >= size:
                    yield out()
                    number, held, raw = number + 1, [], 0
        if held:
            yield out()

    kind = T.StructType.fromJson(docs.select(rest.alias("rest")).schema.jsonValue())["rest"].dataType
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("raw", T.LongType()),
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("texts", T.BinaryType()),
            T.StructField("rest", T.ArrayType(kind)),
        ]
    )
    columns = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary"), rest.alias("rest")
    )
    return saved(columns.mapInArrow(of_batches, schema), "chunks")


def sizes_for(total: int, chunk: int = CHUNK, bucket: int = BUCKET) -> tuple[int, int]:
    """The sizes of a chunk and of a bucket for so many bytes of text."""
    growth = max(math.sqrt(total / GROWN_FROM), 1)
    return int(chunk * min(growth, CHUNK_GROWTH)), int(bucket * min(growth, BUCKET_GROWTH))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(x, field.type) for x, field in zip(columns, schema)], schema=schema)


ANSWER = pa.schema([("chunk", pa.int64()), ("round", pa.int32()), ("bucket", pa.int32()), ("answer", pa.binary())])
ANSWER_DDL = "chunk bigint, round int, bucket int, answer binary"


def _row(chunk: pa.Table) -> dict:
    return {name: chunk[name][0].as_py() for name in ("ids", "sizes", "texts")}


def _answers(answers: pa.Table, wanted: int) -> dict[int, bytes]:
    rows = zip(*(answers[name].to_pylist() for name in ("round", "bucket", "answer")))
    return {bucket: answer for number, bucket, answer in rows if number == wanted}


def with_removed(
    docs: DataFrame,
    finish: Callable[[Chunk, np.ndarray, pa.StructArray], pa.Table],
    schema: T.StructType,
    chunk_size: int = CHUNK,
    bucket_size: int = BUCKET,
    hot: int = HOT,
) -> DataFrame:
    """What ``finish`` makes of each chunk, its removed bytes and its other columns."""
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    chunk_size, bucket_size = sizes_for(total, chunk_size, bucket_size)
    of_docs = chunks(docs, chunk_size)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, math.ceil(total / bucket_size))

    def send_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema(
            [("chunk", pa.int64()), ("bucket", pa.int32())]
            + [(name, pa.binary()) for name in ("names", "counts", "several")]
        )
        for batch in batches:
            for row in batch.to_pylist():
                sent = [(row["chunk"], *x) for x in Chunk(row, buckets).sent_names()]
                yield from _table(sent, kind).to_batches()

    def answer_names(rows: pa.Table) -> pa.Table:
        states = states_of_names(rows, hot)
        keys = zip(rows["chunk"].to_pylist(), rows["bucket"].to_pylist())
        return _table([(chunk, 1, bucket, x) for (chunk, bucket), x in zip(keys, states)], ANSWER)

    def send_records(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        kind = pa.schema(
            [("chunk", pa.int64()), ("bucket", pa.int32())]
            + [(name, pa.binary()) for name in ("texts", "numbers", "ids")]
        )
        if not chunk.num_rows:
            return _table([], kind)
        own = Chunk(_row(chunk), buckets)
        own.records(_answers(answers, 1))
        number = chunk["chunk"][0].as_py()
        return _table([(number, *x) for x in own.sent_records()], kind)

    def answer_records(rows: pa.Table) -> pa.Table:
        masks = masks_of_records(rows)
        keys = zip(rows["chunk"].to_pylist(), rows["bucket"].to_pylist())
        return _table([(chunk, 2, bucket, x) for (chunk, bucket), x in zip(keys, masks)], ANSWER)

    def put_together(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        own = Chunk(_row(chunk), buckets)
        own.records(_answers(answers, 1))
        rest = chunk["rest"].combine_chunks().flatten()
        return finish(own, own.removed(_answers(answers, 2)), rest)

    texts = of_docs.select("chunk", "ids", "sizes", "texts")
    names = texts.mapInArrow(send_names, "chunk bigint, bucket int, names binary, counts binary, several binary")
    states = saved(names.groupBy("bucket").applyInArrow(answer_names, ANSWER_DDL), "states")
    records = (
        texts.groupBy("chunk")
        .cogroup(states.groupBy("chunk"))
        .applyInArrow(send_records, "chunk bigint, bucket int, texts binary, numbers binary, ids binary")
    )
    masks = saved(records.groupBy("bucket").applyInArrow(answer_records, ANSWER_DDL), "masks")
    return (
        of_docs.drop("raw")
        .groupBy("chunk")
        .cogroup(states.unionByName(masks).groupBy("chunk"))
        .applyInArrow(put_together, schema)
    )


def _per_document(own: Chunk, removed: np.ndarray) -> Iterator[tuple[bytes, np.ndarray]]:
    """The bytes that are kept of each document, and which of its bytes are removed."""
    for start, end in zip((own.ends - own.sizes).tolist(), own.ends.tolist()):
        gone = removed[start:end]
        text = own.text[start:end]
        yield (own.data[start:end][~gone].tobytes() if gone.any() else text), gone


def repeat_report(docs: DataFrame, **sizes: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs``."""

    def finish(own: Chunk, removed: np.ndarray, rest: pa.StructArray) -> pa.Table:
        found = []
        for kept, gone in _per_document(own, removed):
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            found.append((len(gone), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        counts = list(zip(*found))
        columns = [pa.array(x, pa.int64()) for x in counts[:3]]
        return pa.table(
            [rest.field("doc_id"), *columns, pa.array(counts[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            *[T.StructField(name, T.LongType()) for name in ("n_bytes", "n_removed", "n_spans")],
            T.StructField("kept_sha256", T.StringType()),
        ]
    )
    return with_removed(docs.select("doc_id", "text"), finish, schema, **sizes)


def without_repeats(docs: DataFrame, **sizes: int) -> DataFrame:
    """The documents without their repeated passages; the columns are those of ``docs``.

    Bytes of characters that are cut in two go as well. A document that loses all of its
    text to repeats is left out. ``n_chars``, if there is one, follows the text.
    """
    names = docs.columns
    schema = T.StructType([T.StructField(x.name, x.dataType) for x in docs.schema])
    counted = "n_chars" in names
    is_null = null_name(docs)

    def finish(own: Chunk, removed: np.ndarray, rest: pa.StructArray) -> pa.Table:
        texts, stays = [], []
        nulls = rest.field(is_null).to_pylist()
        for null, (kept, gone) in zip(nulls, _per_document(own, removed)):
            text = kept.decode("utf-8", errors="ignore")
            texts.append(None if null else text)
            stays.append(bool(text.strip()) or not gone.any())
        columns = []
        for name in names:
            if name == "text":
                columns.append(pa.array(texts, pa.string()))
            elif name == "n_chars" and counted:
                old = rest.field(name)
                new = [
                    value if len(text or "") == size else len(text)
                    for value, text, size in zip(old.to_pylist(), texts, _lengths(own))
                ]
                columns.append(pa.array(new, old.type))
            else:
                columns.append(rest.field(name))
        return pa.table(columns, names=names).filter(pa.array(stays, pa.bool_()))

    return with_removed(docs, finish, schema, **sizes)


def _lengths(own: Chunk) -> Iterator[int]:
    """The number of characters of each document."""
    for start, end in zip((own.ends - own.sizes).tolist(), own.ends.tolist()):
        yield len(own.text[start:end].decode("utf-8", errors="ignore"))
