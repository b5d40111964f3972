"""Exact top-k search by inner product, as branch and bound over columns.

Vectors become whole numbers, floor(256 x). Queries and candidates are dealt by hash to
blocks of bounded size, and each block of queries meets each block of candidates in a task
of its own. There the candidates are stored by dimension. For each query the products are
added up dimension block by dimension block, those with the most mass first. What the
other dimensions can still add is bounded by the product of the norms of what remains
(Cauchy-Schwarz). A candidate whose upper bound is below the k-th best lower bound can't be
among the k best; survivors are compacted after each block.

Defined results: vectors that are null, or hold a null, NaN or infinite component, and rows
without an id take no part. Candidates with another number of dimensions than the query take
no part in its search. Rows that share the query's id are its own. Equal scores go to the
smaller id. Sums must fit into 64 bits. Other columns don't matter.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.saving import saved

K = 5
SCALE = 256
BLOCK = 8192
DIMENSIONS_AT_ONCE = 16


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dims, x) with whole components, for the vectors that take part."""
    infinity = F.lit(math.inf)

    def finite(x):
        y = x.cast("double")
        return y.isNotNull() & ~F.isnan(y) & (F.abs(y) < infinity)

    usable = F.coalesce(F.forall("embedding", finite), F.lit(False))
    return vectors.filter(F.col("vec_id").isNotNull() & usable).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.size("embedding").alias("dims"),
        F.transform("embedding", lambda x: F.floor(scale * x.cast("double"))).alias("x"),
    )


def best_of_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[list, list, list]:
    """The k best candidates of each query: query ids, candidate ids, scores."""
    order = np.argsort(-np.abs(vectors).sum(axis=0, dtype=np.float64), kind="stable")
    columns = np.ascontiguousarray(vectors.T[order])
    queries = queries[:, order]
    starts = range(0, len(columns), DIMENSIONS_AT_ONCE)
    norms = [
        np.sqrt(np.square(columns[start + DIMENSIONS_AT_ONCE :], dtype=np.float64).sum(axis=0))
        for start in starts
    ]
    found = ([], [], [])
    for query_id, query in zip(query_ids, queries):
        alive = np.flatnonzero(ids != query_id)
        scores = np.zeros(len(alive), np.int64)
        for start, norm in zip(starts, norms):
            stop = start + DIMENSIONS_AT_ONCE
            block = columns[start:stop]
            scores += query[start:stop] @ (block if len(alive) == len(ids) else block[:, alive])
            if len(alive) <= k:
                continue
            mass = np.sqrt(np.square(query[stop:], dtype=np.float64).sum())
            # A little more than the bound, so that rounding never excludes a candidate.
            rest = mass * norm[alive] * (1 + 1e-9) + 1
            least = np.partition(scores - rest, -k)[-k]
            keep = scores + rest >= least
            alive, scores = alive[keep], scores[keep]
        best = np.lexsort((ids[alive], -scores))[:k]
        found[0].extend([query_id] * len(best))
        found[1].extend(ids[alive[best]])
        found[2].extend(scores[best])
    return found


def top_k(
    vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best candidates of each row with ``is_query``."""

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if queries.empty or candidates.empty:
            return pd.DataFrame({name: pd.Series([], dtype="int64") for name in names})
        dims = int(candidates["dims"].iloc[0])
        stacked = [
            np.array(list(side["x"]), np.int64).reshape(len(side), dims)
            for side in (queries, candidates)
        ]
        found = best_of_block(
            queries["vec_id"].to_numpy(), stacked[0], candidates["vec_id"].to_numpy(), stacked[1], k
        )
        return pd.DataFrame(dict(zip(names, found))).astype("int64")

    whole = saved(whole_vectors(vectors, scale), "vectors")
    queries = whole.filter(is_query).distinct()
    shelves = max(1, math.ceil(whole.count() / block))
    groups = max(1, math.ceil(queries.count() / block))
    cell = ["dims", "shelf", "part"]
    asked = queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups))).withColumn(
        "shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1)).cast("array<bigint>"))
    )
    offered = whole.withColumn("shelf", F.pmod(F.xxhash64("vec_id", "x"), F.lit(shelves))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>"))
    )
    found = (
        asked.groupBy(*cell)
        .cogroup(offered.groupBy(*cell))
        .applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    )
    ranked = found.withColumn(
        "rank",
        F.row_number().over(
            Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        ),
    )
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
