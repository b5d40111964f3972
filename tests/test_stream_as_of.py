import datetime as dt

from daybook.streaming.as_of import run_as_of
from daybook.streaming.choices import change_events

START = dt.datetime(2001, 1, 1)
ROWS = "id long, k string, ts timestamp"
SEEN = "seen long, k string, ts timestamp, value long"


def at(minute):
    return START + dt.timedelta(minutes=minute)


ROW_PARTS = [[(1, "a", at(5)), (2, "b", at(6))], [(3, "a", at(40)), (4, "a", at(10)), (5, None, at(41))], [(6, "b", at(200))]]
SEEN_PARTS = [[(1, "a", at(1), 10)], [(2, "a", at(9), 20), (3, "b", at(7), 30), (4, "a", at(9), 25)], [(5, "c", at(200), 0)]]


def test_rows_meet_their_latest_observation(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("rows", "seen")}

    def write(number):
        for name, parts, schema in (("rows", ROW_PARTS, ROWS), ("seen", SEEN_PARTS, SEEN)):
            spark.createDataFrame(parts[number], schema).coalesce(1).write.mode("append").parquet(paths[name])

    def run():
        streams = [
            change_events(spark, paths[name], spark.createDataFrame([], schema).schema, 1)
            for name, schema in (("rows", ROWS), ("seen", SEEN))
        ]
        found = run_as_of(
            *streams, ["k"], "ts", "id", "seen", ["seen", "value"], "20 minutes", "30 minutes", str(tmp_path / "work"), 2
        )
        return {r.id: None if r.observed is None else (r.observed.seen, r.observed.value) for r in found.collect()}

    write(0)
    assert run()[1] == (1, 10)
    write(1)
    # The later observation of 9 minutes is chosen for row 4, by its number.
    assert run()[4] == (4, 25)
    write(2)
    found = run()
    # Row 3 is beyond the horizon, 2 is before its only observation, 5 has no key: alone once
    # the watermark has passed them. Row 6 may still meet one.
    assert found == {1: (1, 10), 2: None, 3: None, 4: (4, 25), 5: None}
    assert run() == found
