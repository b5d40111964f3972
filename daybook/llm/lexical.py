"""Ranked lexical search with range-maximum tables over posting lists.

The items are asked in blocks of bounded size. For a block, every document is read once for
the terms of the block: its number of terms and how often it holds each of them. These rows
give the statistics of the whole table and the weights, and are then searched where they lie.
A task takes them in shards of ``SHARD`` documents, sorted by id. Each term of a shard has a
posting list in that order, with its impacts, and a sparse table that tells the posting of
the largest impact in any range of a list by comparing two entries.

A search is best first. What a document interval can reach is at most the sum, over the
item's terms, of the largest impacts in it. The intervals with the highest sums are taken;
each is split at its document of the highest single impact, which is scored, and both sides
get new sums. Intervals of a few documents are scored whole. The search ends when no sum
reaches the k-th best score. That score is kept from shard to shard, so later shards are
mostly refused by their first sum. A task hands on k rows for each item.

Defined results: a null or empty text has no term and takes no part, as an item or as a
document. Each row of ``documents`` is a document of its own, so repeated rows of one id are
ranked apart; equal scores go to the smaller id, a null id comes last. Repeated rows of items
with the same id and text are one item; texts that share an id are ranked apart. Very long
texts are read in pieces that end between terms. Sums must fit into 64 bits. Empty tables
give no rows. Only doc_id, item_id and text are read; other columns don't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.saving import saved

K = 10
#: Length counts for 75 of 100 parts, against the mean length.
LENGTH_PART = 75
#: Items, and pairs of an item and a term, in a block.
BLOCK_ITEMS = 2048
BLOCK_PAIRS = 200_000
#: Documents, and postings, in a shard; intervals up to LEAF documents are scored whole.
SHARD = 8192
SHARD_POSTINGS = 1_000_000
LEAF = 16
AT_ONCE = 64
PIECE = 1 << 20

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in lists, A to Z lower-cased."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + PIECE)
        stop = gap.start() if gap else len(text)
        yield _TERM.findall(text[start:stop].lower())
        start = stop


def count_terms(text: bytes | None) -> Counter:
    counts: Counter = Counter()
    for terms in terms_of(text or b""):
        counts.update(terms)
    return counts


def asked_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms, counts) of the items that have a term."""

    def read(batches):
        for batch in batches:
            rows = [
                (item, *zip(*sorted(counts.items())))
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                if (counts := count_terms(text))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row[i] for row in rows], kind)
                    for i, kind in enumerate((pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())))
                ],
                names=["item_id", "terms", "counts"],
            )

    texts = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    return texts.select("item_id", F.col("text").cast("binary")).mapInArrow(
        read, "item_id bigint, terms array<binary>, counts array<bigint>"
    )


def counted_terms(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): the length of each document and its known terms."""

    def read(batches):
        for batch in batches:
            ids, sizes, ends, terms, counts = [], [], [0], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = count_terms(text)
                if not found:
                    continue
                ids.append(doc)
                sizes.append(found.total())
                for term in found.keys() & number.keys():
                    terms.append(number[term])
                    counts.append(found[term])
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary")).mapInArrow(
        read, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
    )


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Shard:
    """Posting lists of some documents, in the order of the documents, with range maxima."""

    def __init__(self, terms: np.ndarray, places: np.ndarray, impacts: np.ndarray, docs: int):
        keep = impacts > 0
        keys = terms[keep].astype(np.int64) * docs + places[keep]
        order = np.argsort(keys, kind="stable")
        self.docs = docs
        self.keys = keys[order]
        self.places = places[keep][order]
        self.impacts = impacts[keep][order]
        self.lists = np.unique(terms[keep])
        longest = int(np.bincount(self.keys // docs).max()) if len(keys) else 0
        #: best[j][i] is the place of the largest of the 2**j impacts from i on.
        self.best = [np.arange(len(keys), dtype=np.int32)]
        while 2 ** len(self.best) <= longest:
            step = 2 ** (len(self.best) - 1)
            left, right = self.best[-1][:-step], self.best[-1][step:]
            better = np.where(self.impacts[right] > self.impacts[left], right, left)
            self.best.append(np.concatenate([better, self.best[-1][-step:]]))
        self.best = np.stack(self.best)

    def ranges(self, terms: np.ndarray, lows: np.ndarray, highs: np.ndarray):
        """Where the postings of each interval begin and end in each list."""
        base = terms.astype(np.int64)[None, :] * self.docs
        return (
            np.searchsorted(self.keys, base + lows[:, None]),
            np.searchsorted(self.keys, base + highs[:, None]),
        )

    def bounds(self, terms: np.ndarray, times: np.ndarray, lows: np.ndarray, highs: np.ndarray):
        """The sum of the largest impacts in each interval, and where to split it."""
        first, end = self.ranges(terms, lows, highs)
        size = end - first
        level = np.frexp(np.maximum(size, 1))[1] - 1
        last = np.maximum(end - (1 << level), 0)
        left = self.best[level, np.minimum(first, len(self.keys) - 1)]
        right = self.best[level, last]
        top = np.where(self.impacts[right] > self.impacts[left], right, left)
        reach = np.where(size > 0, self.impacts[top] * times[None, :], 0)
        widest = reach.argmax(axis=1)
        split = self.places[top[np.arange(len(top)), widest]]
        return reach.sum(axis=1), split

    def scores(self, terms: np.ndarray, times: np.ndarray, lows: np.ndarray, highs: np.ndarray):
        """The documents of the intervals that hold a term, and their scores."""
        first, end = self.ranges(terms, lows, highs)
        size = (end - first).ravel()
        stops = np.cumsum(size)
        at = np.arange(stops[-1]) + np.repeat(first.ravel() - stops + size, size)
        of = np.repeat(np.tile(times, len(lows)), size)
        docs, slot = np.unique(self.places[at], return_inverse=True)
        total = np.zeros(len(docs), np.int64)
        np.add.at(total, slot, self.impacts[at] * of)
        return docs, total


class Best:
    """The k best documents found so far; a null id is the largest."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    def least(self) -> int:
        """What a document has to reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        nulls = np.concatenate([self.nulls, nulls])
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


def search(shard: Shard, terms: np.ndarray, times: np.ndarray, ids, nulls, best: Best) -> None:
    """Add the documents of a shard that belong to the best for one item."""
    known = np.isin(terms, shard.lists, assume_unique=True)
    terms, times = terms[known], times[known]
    if not len(terms):
        return
    lows, highs = np.array([0]), np.array([shard.docs])
    reach, split = shard.bounds(terms, times, lows, highs)
    while True:
        open_ = reach >= best.least()
        reach, split, lows, highs = reach[open_], split[open_], lows[open_], highs[open_]
        if not len(reach):
            return
        order = np.argsort(-reach, kind="stable")
        now, later = order[:AT_ONCE], order[AT_ONCE:]
        small = highs[now] - lows[now] <= LEAF
        leaf, cut = now[small], now[~small]
        docs, scores = shard.scores(
            terms,
            times,
            np.concatenate([lows[leaf], split[cut]]),
            np.concatenate([highs[leaf], split[cut] + 1]),
        )
        good = scores >= best.least()
        best.add(scores[good], ids[docs[good]], nulls[docs[good]])
        new_lows = np.concatenate([lows[cut], split[cut] + 1])
        new_highs = np.concatenate([split[cut], highs[cut]])
        some = new_lows < new_highs
        new_lows, new_highs = new_lows[some], new_highs[some]
        new_reach, new_split = shard.bounds(terms, times, new_lows, new_highs)
        reach = np.concatenate([reach[later], new_reach])
        split = np.concatenate([split[later], new_split])
        lows = np.concatenate([lows[later], new_lows])
        highs = np.concatenate([highs[later], new_highs])


def _shards(batches):
    """(ids, nulls, n, owner of each posting, terms, counts) of some documents, sorted by id."""
    held, docs, postings = [], 0, 0

    def made():
        table = pa.Table.from_batches(held).combine_chunks()
        columns = {name: table.column(name).combine_chunks() for name in table.column_names}
        ids, nulls = columns["doc_id"].fill_null(0).to_numpy(), columns["doc_id"].is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((ids, nulls))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sizes = np.diff(columns["terms"].offsets.to_numpy())
        terms, counts = (columns[name].flatten().to_numpy() for name in ("terms", "counts"))
        return ids[order], nulls[order], columns["n"].to_numpy()[order], np.repeat(place, sizes), terms, counts

    for batch in batches:
        for start in range(0, len(batch), 1024):
            part = batch.slice(start, 1024)
            held.append(part)
            docs += len(part)
            postings += len(part.column("terms").flatten())
            if docs >= SHARD or postings >= SHARD_POSTINGS:
                yield made()
                held, docs, postings = [], 0, 0
    if docs:
        yield made()


def _block_ranking(docs: DataFrame, asked: list, k: int) -> DataFrame | None:
    """The best documents for each item of a block, by tasks; None without any document."""
    number = {term: i for i, term in enumerate(sorted({term for row in asked for term in row.terms}))}
    counted = saved(counted_terms(docs, number), "counted")
    documents, total = counted.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count()
    weights = np.zeros(len(number), np.int64)
    for term, count in holding.collect():
        weights[term] = weight(documents, count)
    items = [
        (
            place,
            row.item_id,
            np.array([number[term] for term in row.terms], np.int64),
            np.array(row.counts, np.int64),
        )
        for place, row in enumerate(asked)
    ]

    def find(batches):
        bests = [Best(k) for _ in items]
        for ids, nulls, n, places, terms, counts in _shards(batches):
            m = 100 - LENGTH_PART + LENGTH_PART * n * documents // total
            impacts = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m[places]))
            shard = Shard(terms, places, impacts, len(ids))
            for (_, _, wanted, times), best in zip(items, bests):
                search(shard, wanted, times, ids, nulls, best)
        for (place, item, _, _), best in zip(items, bests):
            size = len(best.scores)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([place] * size, pa.int32()),
                    pa.array([item] * size, pa.int64()),
                    pa.array(best.ids, pa.int64(), mask=best.nulls),
                    pa.array(best.scores, pa.int64()),
                ],
                names=["place", "item_id", "doc_id", "score"],
            )

    found = counted.mapInArrow(find, "place int, item_id bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    block_items: int = BLOCK_ITEMS,
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    asked = saved(asked_terms(items), "asked")
    many, pairs = asked.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(math.ceil(many / block_items), math.ceil(pairs / block_pairs))
    rankings = []
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block
        rows = sorted(asked.filter(mine).collect(), key=lambda row: (row.item_id is None, row.item_id or 0, row.terms))
        ranking = _block_ranking(docs, rows, k) if rows else None
        if ranking is not None:
            rankings.append(ranking if blocks == 1 else saved(ranking, "ranking"))
    if not rankings:
        return docs.sparkSession.createDataFrame(
            [], "item_id bigint, rank int, doc_id bigint, score bigint"
        )
    return reduce(DataFrame.unionAll, rankings)
