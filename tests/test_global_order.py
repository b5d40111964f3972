"""Order of a whole table, snapshots and sketches against plain Python."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.operators import global_order, sketches, snapshots
from daybook.operators.lookups import Salting
from daybook.operators.segments import Cutting

FINE = Cutting(sample_rows=2000, sample_rows_per_segment=4, smallest_segment=8)
SALTS = Salting(sample_rows=2000, sample_rows_per_part=4, smallest_table=8)
ROWS = [(i * 37 % 101 if i % 3 else 50, i, i % 7) for i in range(300)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "v int, id int, amount int").repartition(5)


@pytest.mark.parametrize("cutting", [FINE, Cutting()])
def test_row_numbers_and_tiles(table, cutting):
    ordered = sorted(ROWS)
    found = global_order.row_numbers(table, ["v", "id"], cutting=cutting).collect()
    assert {(r.v, r.id): r.number for r in found} == {(v, i): n for n, (v, i, _) in enumerate(ordered, 1)}
    for count in (7, 299, 400):
        tiled = global_order.tiles(table, ["v", "id"], count, cutting=cutting).collect()
        sizes = Counter(r.tile for r in tiled)
        size, larger = divmod(300, count)
        assert sizes == {n: size + (n <= larger) for n in range(1, min(count, 300) + 1)}
        tiles = [r.tile for r in sorted(tiled, key=lambda r: (r.v, r.id))]
        assert tiles == sorted(tiles)


def test_the_order_was_cut(spark, table):
    cut = global_order._cut(table, ["v", "id"], FINE, None)
    sizes = [row["count"] for row in cut.groupBy("_segment").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 40


@pytest.mark.parametrize("cutting", [FINE, Cutting()])
def test_ranks_with_ties(table, cutting):
    values = sorted(v for v, _, _ in ROWS)
    dense = {v: n for n, v in enumerate(sorted(set(values)), 1)}
    found = global_order.ranked_rows(table, ["v"], "amount", cutting, SALTS).collect()
    assert len(found) == 300
    for row in found:
        total = sum(amount for v, _, amount in ROWS if v <= row.v)
        assert (row["rank"], row.dense_rank, row.total) == (values.index(row.v) + 1, dense[row.v], total)


def test_null_values_come_first(spark):
    table = spark.createDataFrame([(None, 1), (3, 2), (None, 3), (1, None)], "v int, amount int")
    found = {r.v: (r.rows, r["rank"], r.total) for r in global_order.value_ranks(table, ["v"], "amount").collect()}
    assert found == {None: (2, 1, 4), 1: (1, 3, 4), 3: (1, 4, 6)}


@pytest.mark.parametrize("count", [1, 40, 1000])
def test_top_with_ties(table, count):
    values = sorted(v for v, _, _ in ROWS)
    expected = sorted((v, i, values.index(v) + 1) for v, i, _ in ROWS if values.index(v) < count)
    found = global_order.top_with_ties(table, ["v"], count).collect()
    assert sorted((r.v, r.id, r["rank"]) for r in found) == expected


def test_empty_table(spark):
    none = spark.createDataFrame([], "v int, id int")
    assert global_order.row_numbers(none, ["v"]).count() == 0
    assert global_order.tiles(none, ["v"], 3).count() == 0
    assert global_order.value_ranks(none, ["v"], "id").count() == 0
    assert global_order.top_with_ties(none, ["v"], 3).count() == 0


OLD = [(1, "a"), (1, "a"), (2, None), (3, "c"), (4, "d"), (None, "n"), (5, "e"), (5, "f")]
NEW = [(1, "a"), (2, None), (3, "C"), (6, "g"), (6, "g"), (None, "N"), (5, "e"), (5, "h"), (5, "i")]


@pytest.mark.parametrize("buckets", [1, 3, 1000])
def test_snapshot_difference(spark, buckets):
    old, new = (spark.createDataFrame(rows, "k int, v string") for rows in (OLD, NEW))
    plus, minus = Counter(NEW) - Counter(OLD), Counter(OLD) - Counter(NEW)
    expected = [("added", n, *row) for row, n in plus.items()] + [("removed", n, *row) for row, n in minus.items()]
    found = snapshots.difference(old, new, ["k"], buckets).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    kinds = Counter((r.kind, r.k) for r in snapshots.changes(old, new, ["k"], buckets).collect())
    assert kinds == {
        ("removed", 1): 1, ("changed", 3): 1, ("removed", 4): 1, ("added", 6): 1, ("changed", None): 1,
        ("removed", 5): 1, ("added", 5): 2,
    }


def test_only_unlike_buckets_are_compared(spark):
    old = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 9).alias("v"))
    new = old.withColumn("v", F.when(F.col("k") == 77, -1).otherwise(F.col("v"))).repartition(7)
    assert snapshots.unlike_buckets(old, new, ["k"], 512).count() == 1
    assert snapshots.unlike_buckets(old, old.repartition(3), ["k"], 512).count() == 0
    row = snapshots.changes(old, new, ["k"], 512).collect()
    assert [(r.kind, r.k, r.before.v, r.after.v) for r in row] == [("changed", 77, 77 % 9, -1)]


def test_sketches_merge_and_keep_their_bounds(spark):
    sales = spark.range(60000).select(
        (F.col("id") % 5).alias("region"),
        (F.col("id") % 4).alias("month"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20000).alias("customer"),
        F.col("id").alias("amount"),
    )
    cells = sketches.sketch_cells(sales, ["region", "month"])
    whole = sketches.merged_cells(sketches.merged_cells(cells, ["region"]).withColumn("all", F.lit(0)), ["all"])
    row = whole.select(
        "records",
        sketches.distinct_customers().alias("customers"),
        sketches.amount_quantile(0.25).alias("quarter"),
        sketches.frequent_customers(1).alias("most"),
    ).first()
    exact = sales.select("customer").distinct().count()
    assert row.records == 60000
    assert abs(row.customers - exact) <= sketches.DISTINCT_ERROR * exact
    assert abs(row.quarter / 60000 - 0.25) <= sketches.RANK_ERROR
    assert row.most[0]["item"] == 1 and abs(row.most[0]["count"] - 20000) <= 60000 / sketches.MOST_TRACKED * 4
