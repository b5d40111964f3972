from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.operators.latest import latest_value
from daybook.operators.lookups import (
    Salting,
    as_of_lookup,
    current_value,
    first_match,
    fits_broadcast,
    hot_keys,
    label_lookup,
    lookup_join,
    with_status,
)
from daybook.operators.segments import Cutting, add_segments, cut_points
from daybook.sources.literals import CITIES, code_table
from daybook.sources.payloads import with_coordinates, with_weather

FINE = Cutting(sample_rows=400, sample_rows_per_segment=5, smallest_segment=10)


def hot_rows(spark, rows=6000):
    """Key 0 holds more than a third of the rows; some of its times are equal."""
    return spark.range(rows).select(
        F.when(F.col("id") % 5 < 2, 0).otherwise(F.col("id") % 50).alias("key"),
        F.floor(F.col("id") / 7).alias("ts"),
        F.col("id"),
        F.when(F.pmod(F.hash("id"), F.lit(9)) == 0, F.col("id")).alias("item"),
        (F.pmod(F.hash("id"), F.lit(9)) == 0).alias("seen"),
    )


def test_hot_keys_are_cut(spark):
    rows = hot_rows(spark)
    cuts = cut_points(rows, ["key"], ["ts", "id"], rows.count(), FINE)
    of_hot = cuts.filter("_cut_key = 0").orderBy("_number").collect()
    assert [r["_number"] for r in of_hot] == list(range(1, len(of_hot) + 1)) and len(of_hot) > 10
    assert [r["_place"] for r in of_hot] == sorted(r["_place"] for r in of_hot)
    assert cuts.count() <= FINE.sample_rows / FINE.sample_rows_per_segment * 2
    cut = add_segments(rows, ["key"], ["ts", "id"], FINE)
    sizes = cut.groupBy("key", "_segment").count()
    assert sizes.agg(F.max("count")).first()[0] < rows.count() / 10
    places = [(r["_place"].ts, r["_place"].id) for r in of_hot]
    for row in cut.filter("key = 0").collect():
        assert row["_segment"] == sum(place <= (row.ts, row.id) for place in places)
        assert row["_cuts_of_key"] == len(places)


def test_small_tables_are_not_cut(spark):
    cut = add_segments(hot_rows(spark), ["key"], ["ts", "id"])
    assert cut.agg(F.max("_segment")).first()[0] == 0


def test_current_value_of_hot_keys(spark):
    rows = hot_rows(spark)
    found = current_value(rows, ["key"], ["ts", "id"], F.col("seen"), ["id"], "current", FINE)
    window = Window.partitionBy("key").orderBy("ts", "id")
    expected = rows.select("id", F.last("item", ignorenulls=True).over(window).alias("e"))
    both = found.select("id", F.col("current.id").alias("f")).join(expected, "id")
    assert both.count() == rows.count()
    assert both.filter("NOT (f <=> e)").count() == 0


def test_as_of_lookup_matches_brute_force(spark):
    choices = spark.range(600).select(
        F.col("id").alias("choice"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("city"),
        F.pmod(F.hash("id"), F.lit(300)).alias("ts"),
        F.concat(F.lit("u"), "id").alias("user"),
    )
    observations = spark.range(500).select(
        F.col("id").alias("obs"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 8 + 1).alias("city"),
        F.pmod(F.hash("id", F.lit(5)), F.lit(300)).alias("ts"),
        F.when(F.col("id") % 4 != 0, F.col("id")).alias("temperature"),
    )
    for cutting in (FINE, Cutting()):
        found = as_of_lookup(
            choices, observations, ["city"], "ts", "choice", "obs", ["obs", "temperature"],
            "seen", cutting,
        )
        assert found.columns == ["city", "ts", "choice", "user", "seen"]
        o = observations.select(
            F.col("city").alias("c"), F.col("ts").alias("t"), "obs", "temperature"
        )
        expected = (
            choices.join(o, (F.col("city") == F.col("c")) & (F.col("t") <= F.col("ts")), "left")
            .groupBy("choice")
            .agg(F.max_by(F.struct("obs", "temperature"), F.struct("t", "obs")).alias("e"))
        )
        rows = found.join(expected, "choice").select("seen", "e.*").collect()
        assert len(rows) == 600
        for row in rows:
            if row.obs is None:
                assert row.seen is None
            else:
                assert (row.seen.obs, row.seen.temperature) == (row.obs, row.temperature)


def test_first_match_takes_the_best_candidate(spark):
    cities = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "city string")
    candidates = spark.createDataFrame(
        [("a", 2, 1.0), ("a", 1, 2.0), ("b", None, 3.0), ("b", 9, 4.0), (None, 1, 5.0)],
        "city string, place int, lat double",
    )
    found = first_match(cities, candidates, ["city"], [F.col("place")])
    assert {(r.city, r.match.lat if r.match else None) for r in found.collect()} == {
        ("a", 2.0), ("b", 4.0), ("c", None), (None, None)
    }


def test_lookup_join_splits_hot_keys(spark):
    left = hot_rows(spark)
    right = spark.range(45).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    fine = Salting(sample_rows=6000, sample_rows_per_part=600, smallest_table=10)
    hot = hot_keys(left, ["key"], left.count(), fine)
    assert {(r["_hot_key"], r["_salts"]) for r in hot.collect()} == {(0, 4)}
    salted = lookup_join(left, right, ["key"], 0, fine)
    plain = left.join(right, "key", "left")
    assert salted.columns == plain.columns
    assert salted.count() == left.count()
    assert salted.exceptAll(plain.select(*salted.columns)).count() == 0
    assert not fits_broadcast(right, 44) and fits_broadcast(right, 45)


def test_lookup_join_with_null_and_text_keys(spark):
    left = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 99)], "key string, n int")
    right = spark.createDataFrame([("a", 1), (None, 2)], "key string, v int")
    found = lookup_join(left, right, ["key"], 0, Salting(100, 5, 10))
    assert found.count() == 51
    assert [(r.key, r.v) for r in found.filter("v IS NOT NULL").collect()] == [("a", 1)]


def test_city_labels(spark):
    rows = spark.createDataFrame([("Seoul",), ("Jeju",)], "city string")
    found = label_lookup(rows, "city", code_table(spark, CITIES), "code", "label", "text")
    assert {tuple(r) for r in found.collect()} == {("Seoul", "서울"), ("Jeju", None)}


def test_status_of_a_lookup_chain(spark):
    answers = spark.createDataFrame(
        [
            ("both", '{"results":[{"latitude":37.566,"longitude":126.9784},{"latitude":1}]}', True,
             '{"current":{"temperature_2m":21.5,"relative_humidity_2m":40}}'),
            ("missing", "{}", True, '{"current":{"temperature_2m":1}}'),
            ("empty", '{"results":[]}', True, '{"current":{"temperature_2m":1}}'),
            ("broken", "oops", True, '{"current":{"temperature_2m":1}}'),
            ("unobserved", '{"results":[{"latitude":1,"longitude":2}]}', None, None),
            ("cold", '{"results":[{"latitude":1,"longitude":2}]}', True,
             '{"current":{"temperature_2m":null,"relative_humidity_2m":5}}'),
        ],
        "city string, geo string, observed boolean, weather string",
    )
    told = with_status(
        with_weather(with_coordinates(answers, "geo"), "weather"),
        "latitude", "observed", "temperature", "latitude", "longitude",
    )
    rows = {r.city: r for r in told.collect()}
    assert {city: r.status for city, r in rows.items()} == {
        "both": "ok",
        "missing": "city_not_found",
        "empty": "city_not_found",
        "broken": "city_not_found",
        "unobserved": "weather_unavailable",
        "cold": "no_temperature",
    }
    assert (rows["both"].latitude_text, rows["both"].longitude_text) == ("37.5660", "126.9784")
    assert (rows["cold"].latitude_text, rows["cold"].humidity) == ("1.0000", 5.0)


def test_latest_value(spark):
    changes = spark.createDataFrame(
        [("u", "Seoul", 2), ("u", "Busan", 1), ("v", "nowhere", 5)], "user string, city string, ts int"
    )
    found = latest_value(changes, ["user"], ["city"], ["ts"])
    assert {tuple(r) for r in found.collect()} == {("u", "Seoul"), ("v", "nowhere")}
