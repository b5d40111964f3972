"""Best-fit packing of documents into bins of equal capacity, without conflicts.

A document's size is its number of words. A document beyond the capacity is cut into pieces
of words, all of which are packed. A bin never holds two pieces of one source, nor two of
one cluster of duplicates. It carries a bitmap of its sources and one of its clusters; bins
are kept in the order of what room they have left. For each piece, the largest first, the
search starts at the tightest bin that has room and goes on to the next larger until one
without a conflict is found; else a new bin is opened.

Pieces are dealt by hash to shards of about ``SHARD`` pieces, each of which is packed by a
task of its own. A source or cluster with a third of all pieces is spread over the shards
like the others. A shard leaves only few bins open, next to the thousands that it fills.

Clusters are given as a column, or are the components of near fingerprints of the SimHash
operator, or else exact copies.

Defined results: a document without words, or with a null text, is one piece of size 0 and in
no cluster of near copies. A piece of unknown source or cluster conflicts with none. Equal rows are packed each on their
own. Only doc_id, text and source are read; other columns don't matter.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.saving import saved
from daybook.llm.simhash import classes

CAPACITY = 1024
SHARD = 4096
WORD = r"[^\x20\x09-\x0D]+"


def exact_cluster(text: Column) -> Column:
    """Exact copies share a cluster; a null text belongs to none."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def sized(docs: DataFrame, cluster: Column | None = None, near_copies: bool = False) -> DataFrame:
    """(doc_id, source, cluster, words) of each row, without its text."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).alias("words")
    if not near_copies:
        chosen = exact_cluster(F.col("text")) if cluster is None else cluster
        return docs.select("doc_id", "source", chosen.alias("cluster"), words)
    light = docs.select("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), words)
    found = classes(docs).withColumnsRenamed({"doc_id": "_id", "hash": "_hash"})
    same = light["doc_id"].eqNullSafe(found["_id"]) & (light["hash"] == found["_hash"])
    return light.join(found, same).select(
        "doc_id", "source", F.when(F.col("words") > 0, F.col("root")).alias("cluster"), "words"
    )


def pieces(counted: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, source, cluster, piece, first_word, n_words): what is to be packed."""
    count = F.greatest(F.ceil(F.col("words") / capacity), F.lit(1)).cast("int")
    numbered = counted.select(
        "*", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece")
    ).withColumn("first_word", F.col("piece").cast("bigint") * capacity)
    return numbered.select(
        "doc_id",
        "source",
        "cluster",
        "piece",
        "first_word",
        F.least(F.col("words") - F.col("first_word"), F.lit(capacity)).cast("bigint").alias("n_words"),
    )


def _bitmaps(values: pd.Series) -> list[int]:
    """A bit for each value that occurs more than once; others can't conflict."""
    several = values.dropna()
    several = several[several.duplicated(keep=False)]
    number = {value: i for i, value in enumerate(several.unique())}
    return [1 << number[value] if value in number else 0 for value in values]


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each piece, numbered from 0; pieces must come in the order of packing."""
    room: list[tuple[int, int]] = []
    held_sources: list[int] = []
    held_clusters: list[int] = []
    bins = []
    for size, source, cluster in zip(sizes, sources, clusters):
        at = bisect_left(room, (size, -1))
        while at < len(room):
            chosen = room[at][1]
            if not (held_sources[chosen] & source or held_clusters[chosen] & cluster):
                break
            at += 1
        if at < len(room):
            left = room.pop(at)[0]
        else:
            chosen, left = len(held_sources), capacity
            held_sources.append(0)
            held_clusters.append(0)
        insort(room, (left - size, chosen))
        held_sources[chosen] |= source
        held_clusters[chosen] |= cluster
        bins.append(chosen)
    return bins


def packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    shard_size: int = SHARD,
    cluster: Column | None = None,
    near_copies: bool = False,
) -> DataFrame:
    """(doc_id, piece, first_word, n_words, bin) for each piece of each document.

    With ``near_copies`` documents whose fingerprints link are a cluster.
    """

    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        ordered = shard.sort_values(
            ["n_words", "doc_id", "piece", "cluster"], ascending=[False, True, True, True]
        )
        bins = best_fit(
            ordered["n_words"].tolist(),
            _bitmaps(ordered["source"]),
            _bitmaps(ordered["cluster"]),
            capacity,
        )
        numbered = ordered.assign(bin=ordered["shard"] * (1 << 32) + pd.Series(bins, ordered.index))
        return numbered[["doc_id", "piece", "first_word", "n_words", "bin"]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    all_pieces = saved(pieces(sized(docs, cluster, near_copies), capacity), "pieces")
    shards = max(1, math.ceil(all_pieces.count() / shard_size))
    dealt = all_pieces.withColumn(
        "shard",
        F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards)),
    )
    return dealt.groupBy("shard").applyInPandas(
        pack, f"doc_id {kind}, piece int, first_word bigint, n_words bigint, bin bigint"
    )
