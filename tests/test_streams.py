from pyspark.sql import functions as F

from daybook.operators.latest import latest_value
from daybook.sources.literals import CITIES, code_table
from daybook.streaming.choices import change_events, run_enriched, run_latest_choice

SCHEMA = "user string, city string, ts int"
FIRST = [("u", "Seoul", 5), ("v", "Busan", 1)]
LATE = [("u", "Busan", 2), ("v", "Jeju", 3), ("w", "Seoul", 1)]


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def latest(spark, source, folder):
    events = change_events(spark, source, spark.read.parquet(source).schema, 1)
    found = run_latest_choice(events, ["user"], ["city"], ["ts"], folder)
    return {r.user: r.city for r in found.collect()}


def test_late_rows_do_not_overwrite(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "work")
    write(spark, FIRST, source)
    assert latest(spark, source, folder) == {"u": "Seoul", "v": "Busan"}
    write(spark, LATE, source)
    expected = {"u": "Seoul", "v": "Jeju", "w": "Seoul"}
    assert latest(spark, source, folder) == expected
    assert latest(spark, source, folder) == expected
    batch = latest_value(spark.read.parquet(source), ["user"], ["city"], ["ts"])
    assert {r.user: r.city for r in batch.collect()} == expected


def test_stream_without_rows(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = spark.createDataFrame([], SCHEMA).schema
    events = change_events(spark, str(source), schema)
    found = run_latest_choice(events, ["user"], ["city"], ["ts"], str(tmp_path / "work"))
    assert found.collect() == []
    same = run_enriched(events, lambda batch: batch.select("user"), str(tmp_path / "other"))
    assert same.columns == ["user"] and same.collect() == []


def test_enriched_stream_keeps_all_rows_once(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "work")
    labels = code_table(spark, CITIES, "city", "label")
    for number, rows in enumerate((FIRST, LATE), start=1):
        write(spark, rows, source)
        events = change_events(spark, source, spark.read.parquet(source).schema)
        found = run_enriched(events, lambda batch: batch.join(labels, "city", "left"), folder)
        assert found.count() == sum(len(part) for part in (FIRST, LATE)[:number])
    assert found.filter(F.col("label").isNull()).count() == 1
    assert {r.label for r in found.collect()} == {"서울", "부산", None}
