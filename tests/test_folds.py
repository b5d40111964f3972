from pyspark.sql import functions as F

from daybook.operators.latest import latest_value
from daybook.streaming.folds import FoldedChanges
from daybook.streaming.choices import change_events, run_latest_choice
from daybook.streaming.quiet_keys import run_latest_choice_of_active_keys

SCHEMA = "user string, city string, ts int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def store_of(spark, folder, every):
    return FoldedChanges(
        spark,
        str(folder),
        frame(spark, []).schema,
        lambda rows: latest_value(rows, ["user"], ["city", "ts"], ["ts", "city"]),
        every,
    )


def changes(number):
    return [(f"u{(number * 7 + i) % 5}", f"c{number}", (number * 37 + i) % 50) for i in range(3)]


def latest_of(numbers):
    best = {}
    for number in numbers:
        for user, city, ts in changes(number):
            best[user] = max(best.get(user, (-1, "")), (ts, city))
    return best


def read(store):
    return {row.user: (row.ts, row.city) for row in store.read().collect()}


def test_many_batches_open_few_files(spark, tmp_path):
    store = store_of(spark, tmp_path, 4)
    for number in range(18):
        store.save(frame(spark, changes(number)), number)
        if number in (0, 4, 17):
            assert read(store) == latest_of(range(number + 1))
    opened = store.read().inputFiles()
    deltas = [name for name in opened if "/changes/" in name]
    assert len({name.split("/snapshots/")[1].split("/")[0] for name in opened if "/snapshots/" in name}) == 1
    assert 0 < len(deltas) <= 4


def test_repeated_and_broken_folds_change_nothing(spark, tmp_path):
    store = store_of(spark, tmp_path, 2)
    for number in (0, 1, 2, 2, 3):
        store.save(frame(spark, changes(number)), number)
    before = read(store)
    assert before == latest_of(range(4))

    broken = store_of(spark, tmp_path, 2)
    broken.fold = lambda rows: rows.withColumn("city", F.raise_error(F.lit("lost")).cast("string"))
    try:
        broken.save(frame(spark, changes(4)), 4)
    except Exception as error:
        assert "lost" in str(error)
    else:
        raise AssertionError("the fold did not break")
    assert read(store) == before
    store.save(frame(spark, changes(4)), 4)
    store._fold_before(2)
    assert read(store) == latest_of(range(5))


def test_a_reader_between_two_manifests(spark, tmp_path):
    """With the later manifest missing, the earlier one still leads to all rows."""
    store = store_of(spark, tmp_path, 2)
    for number in range(7):
        store.save(frame(spark, changes(number)), number)
    frame(spark, []).write.mode("overwrite").parquet(f"{tmp_path}/other")
    empty = spark.createDataFrame([], FoldedChanges._MANIFEST)
    empty.write.mode("overwrite").parquet(f"{tmp_path}/manifest-{3 % 2}")
    assert read(store) == latest_of(range(7))


def test_stream_with_folds(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "work")
    for number in range(7):
        frame(spark, changes(number)).write.mode("append").parquet(source)
    events = change_events(spark, source, frame(spark, []).schema, 1)
    found = run_latest_choice(events, ["user"], ["city"], ["ts", "city"], folder, fold_every=3)
    assert {r.user: r.city for r in found.collect()} == {u: c for u, (_, c) in latest_of(range(7)).items()}


def test_state_of_quiet_keys_ends(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "work")

    def run(rows):
        frame(spark, rows).write.mode("append").parquet(source)
        events = change_events(spark, source, frame(spark, []).schema, 1)
        found, held = run_latest_choice_of_active_keys(
            events, ["user"], ["city"], ["ts", "city"], folder, life_seconds=1, fold_every=2
        )
        return {r.user: r.city for r in found.collect()}, held

    assert run([(f"u{i}", "a", 5) for i in range(40)])[0] == {f"u{i}": "a" for i in range(40)}
    expected = {f"u{i}": "a" for i in range(40)} | {"v": "b"}
    found, held = run([("v", "b", 1)])
    assert found == expected and held < 20
    # A key that comes back with an older row keeps its later choice.
    found, held = run([("u1", "old", 2), ("u2", "new", 9)])
    assert found == expected | {"u2": "new"} and held < 20
    assert run([])[0] == expected | {"u2": "new"}
