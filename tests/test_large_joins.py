"""Skewed joins and joins of ranges against plain loops."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.operators.intervals import interval_join
from daybook.operators.lookups import Salting
from daybook.operators.skewed_joins import grid_sides, skewed_join
from daybook.plans.queries import skewed_full, skewed_pairs

FINE = Salting(sample_rows=5000, sample_rows_per_part=5, smallest_table=4)
LEFT = [(0, i) for i in range(60)] + [(i % 9, 100 + i) for i in range(40)] + [(None, 1), (None, 2), (50, 3), (50, 3)]
RIGHT = [(0, -i) for i in range(45)] + [(i % 12, 200 + i) for i in range(30)] + [(None, 5), (77, 6)]


def frames(spark, left=LEFT, right=RIGHT):
    return spark.createDataFrame(left, "k int, a int"), spark.createDataFrame(right, "k int, b int")


def expected(left, right, how):
    pairs = [(k, a, b) for k, a in left for j, b in right if k is not None and k == j]
    lefts, rights = {k for k, _ in left if k is not None}, {k for k, _ in right if k is not None}
    alone = [(k, a) for k, a in left if k not in rights]
    other = [(k, b) for k, b in right if k not in lefts]
    if how == "semi":
        return [(k, a) for k, a in left if k in rights]
    if how == "anti":
        return alone
    rows = list(pairs)
    if how in ("left", "full"):
        rows += [(k, a, None) for k, a in alone]
    if how in ("right", "full"):
        rows += [(k, None, b) for k, b in other]
    return rows


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("salting", [FINE, Salting()])
def test_skewed_join(spark, how, salting):
    found = [tuple(row) for row in skewed_join(*frames(spark), ["k"], how, salting).collect()]
    assert sorted(found, key=repr) == sorted(expected(LEFT, RIGHT, how), key=repr)


def test_no_cell_holds_much_of_a_hot_key(spark):
    left = spark.range(3000).select(F.lit(7).alias("k"), F.col("id").alias("a"))
    right = spark.range(2000).select(F.lit(7).alias("k"), F.col("id").alias("b"))
    one, other = grid_sides(left, right, ["k"], Salting(5000, 100, 4))
    cells = ["k", "_grid_row", "_grid_column"]
    largest = [side.groupBy(*cells).count().agg(F.max("count")).first()[0] for side in (one, other)]
    assert largest[0] < 3000 / 10 and largest[1] < 2000 / 10


def test_empty_sides_and_shared_names(spark):
    left, right = frames(spark, [], RIGHT)
    assert skewed_join(left, right, ["k"], "inner", FINE).count() == 0
    assert skewed_join(left, right, ["k"], "full", FINE).count() == len(RIGHT)
    with pytest.raises(ValueError, match="both sides"):
        skewed_join(right, right, ["k"])
    with pytest.raises(ValueError, match="how"):
        skewed_join(right, right, ["k"], "cross")


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_interval_join(spark, width):
    left = [(i % 3, i, 5 * i - 40, 5 * i - 40 + i % 30) for i in range(60)] + [(0, 99, 4, None), (0, 98, None, 4), (0, 97, 9, 3)]
    right = [(i % 3, i, 7 * i - 50, 7 * i - 50 + i % 45) for i in range(50)] + [(None, 77, 0, 10)]
    one = spark.createDataFrame(left, "k int, a int, a1 long, a2 long")
    other = spark.createDataFrame(right, "k int, b int, b1 long, b2 long")

    def overlap(x, y):
        if None in (x[2], x[3], y[2], y[3]):
            return False
        return max(x[2], y[2]) < min(x[3], y[3])

    for keys in (["k"], []):
        right_ = other if keys else other.drop("k")
        found = interval_join(one, right_, keys, ("a1", "a2"), ("b1", "b2"), width, FINE)
        pairs = sorted((row.a, row.b) for row in found.collect())
        assert pairs == sorted((x[1], y[1]) for x in left for y in right if overlap(x, y) and (not keys or x[0] == y[0]))
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sums_over_the_pairs_of_hot_keys_list_no_pairs(spark, tmp_path):
    """A hot key with 20,000 events and 10,000 suppliers has 200 million pairs."""
    event = F.when(F.col("id") < 20_000, F.col("id") * 3).otherwise((F.col("id") - 20_000) * 3 + 1)
    events = spark.range(20_300).select(event.alias("event_id"), F.lit("view").alias("event_type"))
    supplier = F.when(F.col("id") < 10_000, F.col("id") * 3).otherwise((F.col("id") - 10_000) * 3 + 2)
    suppliers = spark.range(10_200).select(supplier.alias("s_suppkey"), F.lit(1).alias("s_nationkey"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    suppliers.write.parquet(str(tmp_path / "supplier.parquet"))

    def key(number, others):
        return 0 if number % 3 == 0 else number % others if number % 7 != 1 else None

    lefts = Counter(key(row.event_id, 400) for row in events.collect())
    rights = [(key(row.s_suppkey, 300), row.s_suppkey) for row in suppliers.collect()]
    numbers = Counter(k for k, _ in rights)
    wanted = [(k, s, lefts[k], lefts[k]) if k is not None and lefts[k] else (k, s, 0, 1) for k, s in rights]
    wanted += [(k, None, n, n) for k, n in lefts.items() if k is None or not numbers[k]]
    begun = time.perf_counter()
    found = [tuple(row) for row in skewed_full(spark, str(tmp_path)).collect()]
    pairs = skewed_pairs(spark, str(tmp_path)).collect()
    assert time.perf_counter() - begun < 30
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert [tuple(row) for row in pairs] == [("view", 1, sum(lefts[k] * n for k, n in numbers.items() if k is not None))]
