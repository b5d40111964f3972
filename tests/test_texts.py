from pyspark.sql import functions as F

from daybook.operators.segments import Cutting
from daybook.operators.texts import BAG_HEADING, item_line, ordered_text
from daybook.sources.literals import item_table


def test_item_list(spark):
    items = item_table(
        spark,
        [("노트북", 1), ("펜", 3), ("노트", 2), ("이어폰", 1), ("지갑", 1)],
        "name string, count int",
    ).withColumn("bag", F.lit("mine"))
    line = item_line(F.col("name"), F.col("count"))
    (row,) = ordered_text(items.repartition(3), ["bag"], ["pos"], line, BAG_HEADING).collect()
    assert row.part == 0
    assert row.text == (
        "What's in my bag?\n\n🌀노트북1개\n🌀펜3개\n🌀노트2개\n🌀이어폰1개\n🌀지갑1개\n"
    )


def test_parts_give_the_whole_text(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 30).alias("key"),
        F.hash("id").alias("at"),
        "id",
    )
    line = F.concat(F.col("id").cast("string"), F.lit("\n"))
    cutting = Cutting(sample_rows=300, sample_rows_per_segment=7, smallest_segment=10)
    for cut in (cutting, Cutting()):
        parts = ordered_text(rows, ["key"], ["at", "id"], line, "H\n", 40, cut).collect()
        assert max(r.text.count("\n") for r in parts) <= 41
        expected = {}
        for r in rows.orderBy("at", "id").collect():
            expected.setdefault(r.key, ["H"]).append(str(r.id))
        found = {}
        for r in sorted(parts, key=lambda r: (r.key, r.part)):
            found.setdefault(r.key, []).append(r)
        for key, pieces in found.items():
            assert [p.part for p in pieces] == list(range(len(pieces)))
            assert "".join(p.text for p in pieces).split() == expected[key]
            assert [p.text.count("\n") for p in pieces[1:-1]] == [40] * len(pieces[1:-1])
        assert set(found) == set(expected)
        assert len(found[0]) > 30


def test_missing_text_is_an_empty_line(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 3, "b")], "k int, pos int, t string")
    assert ordered_text(rows, ["k"], ["pos"], F.col("t")).first().text == "ab"
