"""Near-duplicates by SimHash fingerprints, compared in bit-sliced form.

Fingerprints within ``RADIUS`` differing bits are linked. Four blocks of 16 bits can't all
differ then, nor can three: two blocks are equal in any linked pair. So each distinct
fingerprint goes to the six buckets of its pairs of blocks. A bucket with more than
``SLICE`` fingerprints is split by parts of the other 32 bits, one of three of which is again
equal, and what is still too large is cut into slices, each pair of which is a group. Groups
are small, of bounded size and complete: no link is lost.

In a group, 64 fingerprints form a block. Bit p of all of them is one word, the block's plane
p. A fingerprint is compared with a whole block by adding up, plane after plane, the
differing bits in two counter words and an overflow word. Blocks in which all counters
exceed the radius are abandoned.

A group gives links only from each fingerprint to the smallest one of its local component,
never all pairs. Exact copies share a fingerprint and are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.links import components
from daybook.llm.saving import saved

SHINGLE = 3
SEED = 42
RADIUS = 2
SLICE = 4096
SHINGLES_AT_ONCE = 1 << 16
COMPARED_AT_ONCE = 1 << 16
PLANES_AT_ONCE = 8
BLOCKS = list(combinations(range(4), 2))
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
ONE = np.uint64(1)


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The hashes of a text's word shingles, repeats included, in parts of bounded length."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    if len(words) < shingle:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    for start in range(0, len(words) - shingle + 1, SHINGLES_AT_ONCE):
        part = words[start : start + SHINGLES_AT_ONCE + shingle - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def fingerprint_of(hashes: Iterator[np.ndarray]) -> int:
    """The SimHash of hashes, as a signed 64-bit number; 0 if there are none."""
    total, ones = 0, np.zeros(64, np.int64)
    for part in hashes:
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles."""
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print) for each row. A null text is an empty one, with the print 0."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), shingle) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "print"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(of_batches, f"doc_id {kind}, print bigint")


def _bits(start: int, count: int) -> Column:
    return F.shiftrightunsigned("print", start).bitwiseAND(F.lit((1 << count) - 1))


def _bucket_key(number: int, pair: tuple[int, int]) -> Column:
    blocks = F.shiftleft(_bits(16 * pair[0], 16), 16).bitwiseOR(_bits(16 * pair[1], 16))
    return F.lit(number << 32).cast("bigint") + blocks


def _rest(pair: tuple[int, int]) -> Column:
    low, high = [block for block in range(4) if block not in pair]
    return F.shiftleft(_bits(16 * high, 16), 16).bitwiseOR(_bits(16 * low, 16))


def _parts(rest: Column) -> Column:
    """The three parts of the other 32 bits, each marked with its number."""
    part = lambda number, start, count: F.lit(number << 16).cast("bigint") + F.shiftrightunsigned(
        rest, start
    ).bitwiseAND(F.lit((1 << count) - 1))
    return F.array(part(1, 0, 11), part(2, 11, 11), part(3, 22, 10))


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key occurs more than once, with the number of its rows."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return rows.join(counts, keys)


def groups(prints: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """The groups in which the distinct fingerprints ``print`` are to be compared."""
    buckets = F.array(
        *[
            F.struct(_bucket_key(i, pair).alias("key"), _rest(pair).alias("rest"))
            for i, pair in enumerate(BLOCKS)
        ]
    )
    keyed = prints.select("print", F.inline(buckets))
    hot = F.col("n") > slice_size
    split = _shared(keyed, ["key"]).select(
        "print",
        "key",
        F.explode(
            F.when(hot, _parts(F.col("rest"))).otherwise(F.array(F.lit(0).cast("bigint")))
        ).alias("part"),
    )
    sized = _shared(split, ["key", "part"]).withColumn(
        "slices", F.ceil(F.col("n") / slice_size).cast("int")
    )
    own = F.pmod(F.xxhash64("print"), F.col("slices")).cast("int")
    sliced = sized.withColumn("own", own).select(
        "print",
        "key",
        "part",
        F.inline(
            F.transform(
                F.sequence(F.lit(0), F.col("slices") - 1),
                lambda other: F.struct(
                    F.least(F.col("own"), other).alias("one"),
                    F.greatest(F.col("own"), other).alias("other"),
                ),
            )
        ),
    )
    return sliced


def _planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes: word b of plane p has bit p of the fingerprints 64 b to 64 b + 63."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _near(prints, planes, row, block, wanted, radius) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the (row, block) pairs hold near fingerprints, and where in the block.

    The counters start so that they overflow at the first difference beyond the radius.
    """
    preset = (1 << radius.bit_length()) - 1 - radius
    counters = [
        np.full(len(row), ALL if preset >> bit & 1 else 0, np.uint64)
        for bit in range(radius.bit_length())
    ]
    over = np.zeros(len(row), np.uint64)
    own = prints[row]
    near = wanted
    for plane in range(64):
        carry = planes[plane][block] ^ ((own >> np.uint64(plane) & ONE) * ALL)
        for counter in counters:
            rest = counter & carry
            counter ^= carry
            carry = rest
        over |= carry
        if plane % PLANES_AT_ONCE == PLANES_AT_ONCE - 1:
            near = wanted & ~over
            alive = np.flatnonzero(near)
            if len(alive) < len(row):
                row, block, wanted, own = row[alive], block[alive], wanted[alive], own[alive]
                counters = [counter[alive] for counter in counters]
                over, near = over[alive], near[alive]
    return row, block, near


def near_pairs(
    group: np.ndarray, prints: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with near fingerprints within each run of equal group numbers."""
    rows = np.arange(len(prints))
    last = np.searchsorted(group, group, side="right") - 1
    planes = _planes(prints)
    blocks_of = last // 64 - rows // 64 + 1
    ends = np.cumsum(blocks_of)
    start = 0
    while start < len(rows):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + COMPARED_AT_ONCE)))
        row = np.repeat(rows[start:stop], blocks_of[start:stop])
        first = np.repeat(ends[start:stop] - blocks_of[start:stop], blocks_of[start:stop])
        offset = np.arange(len(row)) + (ends[start] - blocks_of[start]) - first
        block = row // 64 + offset
        wanted = np.full(len(row), ALL)
        here = block == row // 64
        wanted[here] = (ALL << (row[here] % 64).astype(np.uint64)) & ~(
            ONE << (row[here] % 64).astype(np.uint64)
        )
        there = block == last[row] // 64
        wanted[there] &= ALL >> (63 - last[row[there]] % 64).astype(np.uint64)
        row, block, near = _near(prints, planes, row, block, wanted, radius)
        bits = np.unpackbits(near.view(np.uint8), bitorder="little").reshape(-1, 64)
        pair, bit = np.nonzero(bits)
        yield row[pair], block[pair] * 64 + bit
        start = stop


def _merge(label: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Give linked rows the smallest label of their component, in place."""
    while True:
        a, b = label[one], label[other]
        apart = a != b
        if not apart.any():
            return
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter


def local_links(group: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is near within each run of equal group numbers."""
    label = np.arange(len(prints))
    for one, other in near_pairs(group, prints, RADIUS):
        _merge(label, one, other)
    linked = np.flatnonzero(label != np.arange(len(prints)))
    return prints[linked], prints[label[linked]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted groups; a group may go on in the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        number, prints = _numbered(held)
        complete = int(np.searchsorted(number, number[-1]))
        yield _as_links(*local_links(number[:complete], prints[:complete]))
        held = held.slice(complete)
    if held is not None:
        yield _as_links(*local_links(*_numbered(held)))


def _numbered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A running group number and the fingerprints of sorted rows."""
    keys = [table.column(name).to_numpy() for name in ("key", "part", "one", "other")]
    new = np.zeros(table.num_rows, bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new), table.column("print").to_numpy().view(np.uint64)


def _as_links(one: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(one.view(np.int64)), pa.array(other.view(np.int64))], ["a", "b"]
    )


def near_links(prints: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within the radius."""
    keys = ["key", "part", "one", "other"]
    grouped = groups(prints, slice_size).repartition(*keys).sortWithinPartitions(*keys, "print")
    return grouped.mapInArrow(_compare, "a bigint, b bigint").distinct()


def labels(of_docs: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """(print, root, component_id) for each distinct fingerprint of (doc_id, print)."""
    distinct = saved(of_docs.groupBy("print").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = saved(components(near_links(distinct, slice_size)), "roots")
    member = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "least_id", F.coalesce("root", "print").alias("root")
    )
    least = member.filter(F.col("root").isNotNull()).groupBy("root").agg(
        F.min("least_id").alias("component_id")
    )
    least = saved(least, "least")
    return saved(member.join(least, "root").select("print", "root", "component_id"), "labels")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, slice_size: int = SLICE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    ``component_id`` is the smallest id that the document reaches over links of near
    fingerprints. Null and empty texts have the fingerprint 0, which links like any other.
    Rows that repeat an id each have their row; a null id never becomes a component's id,
    unless all ids of the component are null.
    """
    of_docs = saved(fingerprints(docs, shingle), "prints")
    return of_docs.join(labels(of_docs, slice_size), "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _hashed_prints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, hash, print): the rows by id and hash of their text."""
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = docs.select(F.struct(F.col("doc_id").alias("id"), text_hash.alias("hash")).alias("doc_id"), "text")
    return saved(fingerprints(keyed, shingle), "prints").select(
        F.col("doc_id.id").alias("doc_id"), F.col("doc_id.hash").alias("hash"), "print"
    )


def classes(docs: DataFrame, shingle: int = SHINGLE, slice_size: int = SLICE) -> DataFrame:
    """(doc_id, hash, root): the component of each unlike pair of an id and a text's hash."""
    of_docs = _hashed_prints(docs, shingle)
    found = of_docs.join(labels(of_docs.select("doc_id", "print"), slice_size), "print")
    return saved(found.groupBy("doc_id", "hash").agg(F.min("root").alias("root")), "classes")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, slice_size: int = SLICE) -> DataFrame:
    """One row of each component: that of its smallest id; all columns as they were.

    A component is connected by steps, so a document may go that is not near the one that
    stays. Of rows that share the smallest id the one with the smallest hash of its text
    stays, of those that share the text too the one with the smallest hash of all columns.
    Names of columns don't matter; ``doc_id`` is a whole number.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    of_docs = _hashed_prints(docs, shingle)
    labelled = labels(of_docs.select("doc_id", "print"), slice_size)
    least = of_docs.join(labelled, "print").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = least.groupBy("root").agg(F.min(F.struct(F.col("doc_id").alias("id"), "hash")).alias("kept"))

    def keys(number: Column, content: Column) -> list[Column]:
        return [number.isNull().alias("no_id"), F.coalesce(number, F.lit(0)).alias("id"), content.alias("hash")]

    kept = chosen.select(*keys(F.col("kept.id"), F.col("kept.hash"))).distinct()
    rows = docs.select(*keys(F.col("doc_id"), text_hash), F.struct(*[docs[name] for name in docs.columns]).alias("row"))
    one = rows.join(kept, ["no_id", "id", "hash"], "left_semi").groupBy("no_id", "id", "hash").agg(
        F.min_by("row", F.xxhash64("row")).alias("row")
    )
    return one.select("row.*")
