import datetime as dt

from pyspark.sql import functions as F

from daybook.streaming.choices import change_events
from daybook.streaming.windows import run_gate, run_windows

SCHEMA = "user string, ts timestamp, value long"
START = dt.datetime(2001, 1, 1)


def rows_of(*minutes):
    return [(f"u{m % 2}", None if m < 0 else START + dt.timedelta(minutes=m), m) for m in minutes]


BATCHES = [rows_of(0, 3, 21, 7), rows_of(12, 25, 4, 30), rows_of(61, 20, -1), rows_of(33, 75)]


def arrived(spark, tmp_path, batches):
    source = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    return change_events(spark, source, spark.createDataFrame([], SCHEMA).schema, 1)


def on_time_and_late(batches, delay):
    latest, good, late = None, [], []
    for rows in batches:
        for row in rows:
            is_late = row[1] is None or (latest is not None and row[1] <= latest - delay)
            (late if is_late else good).append(row)
        times = [row[1] for row in rows if row[1]]
        latest = max([*times, *([latest] if latest else [])], default=None)
    return good, late, latest


def values(df):
    return sorted(row.value for row in df.collect())


def test_gate_parts_the_rows(spark, tmp_path):
    good, late, _ = on_time_and_late(BATCHES, dt.timedelta(minutes=10))
    found = run_gate(arrived(spark, tmp_path, BATCHES), "ts", "10 minutes", str(tmp_path / "work"))
    assert [values(part) for part in found] == [sorted(r[2] for r in part) for part in (good, late)]
    assert late and len(good) + len(late) == sum(map(len, BATCHES))


def closed(spark, rows, window, mark):
    groups = spark.createDataFrame(rows, SCHEMA).groupBy(window.alias("w"), "user")
    found = groups.agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return sorted(
        (r.w.start, r.w.end, r.user, r.n, r.total) for r in found.collect() if r.w.end <= mark
    )


def test_windows_equal_those_of_a_table(spark, tmp_path):
    delay = dt.timedelta(minutes=10)
    measures = [F.count("*").alias("n"), F.sum("value").alias("total")]
    kinds = {
        "tumbling": F.window("ts", "15 minutes"),
        "sliding": F.window("ts", "20 minutes", "10 minutes"),
        "session": F.session_window("ts", "8 minutes"),
    }
    for name, window in kinds.items():
        place = tmp_path / name
        place.mkdir()
        for upto in (2, 4):
            new = BATCHES[upto - 2 : upto]
            events = arrived(spark, place, new)
            found, late = run_windows(events, "ts", "10 minutes", window, ["user"], measures, str(place / "work"))
        good, late_rows, latest = on_time_and_late(BATCHES, delay)
        expected = closed(spark, good, window, latest - delay)
        assert sorted(tuple(row) for row in found.collect()) == expected and expected
        assert values(late) == sorted(row[2] for row in late_rows)


def test_no_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    events = change_events(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema)
    found, late = run_windows(
        events, "ts", "1 minute", F.window("ts", "1 minute"), [], [F.count("*").alias("n")], str(tmp_path / "w")
    )
    assert found.columns == ["start", "end", "n"] and not found.collect() and not late.collect()
