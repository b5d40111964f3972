"""What changed between two snapshots of a table.

Both snapshots are first reduced to a digest per bucket of keys: the number of rows and two
sums of row hashes, so neither order nor layout matters. Only rows of buckets whose digests
differ are compared. Two unlike buckets are taken for equal if the counts and both sums of 64
bits agree, for unlike rows about once in 2**128.

The comparison adds up, for each row content, how often it stands in the new snapshot less
how often in the old one: NULL equals NULL, and repeated rows count. A key that lost one row
and won one is a changed row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 65536
ADDED, REMOVED, CHANGED = "added", "removed", "changed"
_BUCKET = "_bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, rows, one, other): a short row per bucket, formed before the shuffle."""
    columns = sorted(df.columns)
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).alias(name)
        for seed, name in ((1, "one"), (2, "other"))
    ]
    return df.groupBy(_bucket(keys, buckets).alias(_BUCKET)).agg(F.count("*").alias("rows"), *sums)


def unlike_buckets(
    old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """The buckets in which the snapshots differ."""
    before, after = digests(old, keys, buckets), digests(new, keys, buckets)
    names = ("rows", "one", "other")
    renamed = after.select(F.col(_BUCKET).alias("_after"), *[F.col(x).alias(f"_{x}") for x in names])
    same = [before[x].eqNullSafe(renamed[f"_{x}"]) for x in names]
    both = before.join(renamed, before[_BUCKET] == renamed["_after"], "full")
    return both.filter(~(same[0] & same[1] & same[2])).select(
        F.coalesce(_BUCKET, "_after").alias(_BUCKET)
    )


def difference(
    old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """(kind, times, columns): rows added and removed, with how often.

    Both snapshots have the same columns, none of them a map. ``times`` of an added row are
    its rows beyond those of the old snapshot, as ``EXCEPT ALL`` gives them; a removed row is
    the same the other way round.
    """
    columns = old.columns
    wanted = F.broadcast(unlike_buckets(old, new, keys, buckets))

    def signed(df: DataFrame, sign: int) -> DataFrame:
        placed = df.select(*columns, _bucket(keys, buckets).alias(_BUCKET))
        return placed.join(wanted, _BUCKET, "left_semi").select(*columns, F.lit(sign).alias("_sign"))

    net = (
        signed(old, -1)
        .unionByName(signed(new, 1))
        .groupBy(*columns)
        .agg(F.sum("_sign").alias("_net"))
        .filter(F.col("_net") != 0)
    )
    kind = F.when(F.col("_net") > 0, ADDED).otherwise(REMOVED)
    return net.select(kind.alias("kind"), F.abs("_net").alias("times"), *columns)


def changes(
    old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """(kind, keys, before, after): a struct of the other columns of each side.

    A key with one row removed and one added is changed; all other rows are added or removed
    ones, a row per repetition count as in `difference`.
    """
    values = [name for name in old.columns if name not in keys]
    found = difference(old, new, keys, buckets).select("kind", "times", *keys, F.struct(*values).alias("_value"))
    added = F.col("kind") == ADDED
    sides = found.groupBy(*keys).agg(
        F.sum(F.when(added, F.col("times")).otherwise(0)).alias("_added"),
        F.sum(F.when(added, 0).otherwise(F.col("times"))).alias("_removed"),
        F.collect_list(F.struct("kind", "times", "_value")).alias("_rows"),
    )
    single = (F.col("_added") == 1) & (F.col("_removed") == 1)

    def of(kind: str) -> Column:
        return F.get(F.filter("_rows", lambda row: row["kind"] == kind), F.lit(0))["_value"]

    changed = sides.filter(single).select(
        F.lit(CHANGED).alias("kind"), F.lit(1).cast("bigint").alias("times"), *keys, of(REMOVED).alias("before"), of(ADDED).alias("after")
    )
    others = sides.filter(~single).select(*keys, F.inline("_rows"))
    nothing = F.lit(None).cast(found.schema["_value"].dataType)
    is_added = F.col("kind") == ADDED
    return changed.unionByName(
        others.select(
            "kind",
            "times",
            *keys,
            F.when(is_added, nothing).otherwise(F.col("_value")).alias("before"),
            F.when(is_added, F.col("_value")).otherwise(nothing).alias("after"),
        )
    )
