from daybook.operators.scores import (
    attempts_to_hit,
    attempts_until,
    first_valid_scores,
    label_guesses,
    score_results,
)
from daybook.operators.segments import Cutting
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SUBJECTS = ("HTML", "CSS", "JavaScript")
FINE = Cutting(sample_rows=200, sample_rows_per_segment=6, smallest_segment=20)


def score_log(spark, students):
    rows = [
        (student, subject, raw, n)
        for student, entries in students.items()
        for n, (subject, raw) in enumerate(entries)
    ]
    return spark.createDataFrame(rows, "student string, subject string, raw string, ts int")


def in_subjects(*raws):
    return list(zip(SUBJECTS, raws))


def test_score_results(spark):
    log = score_log(
        spark,
        {
            "pass": in_subjects("60", "60", "60"),
            "fail": in_subjects("100", "50", "29"),
            "again": [("HTML", "abc"), *in_subjects("70", "70", "70")],
            "bad": [("HTML", ""), ("HTML", "  "), ("HTML", "1d"), *in_subjects("-1", "100.5", "1e3")],
            "bounds": in_subjects("0", "100", "80"),
            "two": in_subjects("90", "90"),
            "twice": [("HTML", "10"), ("HTML", "100"), *in_subjects("5", "80", "90")],
            "cancelled": [("HTML", "70"), ("CSS", None), ("CSS", "70"), ("JavaScript", "70")],
            "later": [*in_subjects("70", "70", "70"), ("HTML", None)],
            "fractions": in_subjects("0.1", "0.2", "0.3"),
            "other": [*in_subjects("70", "70", "70"), ("Art", "1")],
        },
    )
    results = {r.student: r for r in score_results(log, "student", "subject", "raw", ["ts"]).collect()}
    assert set(results) == {
        "pass", "fail", "again", "bounds", "twice", "later", "fractions", "other"
    }
    assert (results["pass"].total, results["pass"].mean, results["pass"].result) == (180, 60, "합격")
    assert (results["fail"].total, results["fail"].mean) == (179, 179 / 3)
    assert results["fail"].result == "불합격"
    assert results["again"].total == 210
    assert results["bounds"].result == "합격"
    assert results["twice"].total == 10 + 80 + 90
    assert results["fractions"].total == 0.1 + 0.2 + 0.3


def test_first_valid_scores(spark):
    log = score_log(spark, {"a": [("HTML", "x"), ("HTML", "5"), ("HTML", "6"), ("HTML", None)]})
    (row,) = first_valid_scores(log, "student", "subject", "raw", ["ts"]).collect()
    assert (row.score, row.entered.ts, row.cancelled.ts) == (5, 1, 3)


def guess_log(spark, games, target=20):
    rows = [
        (game, target, raw, n) for game, raws in games.items() for n, raw in enumerate(raws)
    ]
    return spark.createDataFrame(rows, "game string, target int, raw string, ts int")


GAMES = {
    "three": ["10", "30", "20"],
    "invalid": ["abc", "20"],
    "blank": ["", "20"],
    "wide": ["99", "20"],
    "never": ["10", "30"],
    "after": ["20", "5"],
    "cancelled": ["10", None, "20"],
    "cancelled later": ["1", "20", None],
}
ATTEMPTS = {"three": 3, "invalid": 1, "blank": 2, "wide": 2, "after": 1, "cancelled later": 2}


def test_attempts_to_hit(spark):
    log = guess_log(spark, GAMES)
    found = attempts_to_hit(log, "game", "raw", "target", ["ts"]).collect()
    assert {r.game: r.attempts for r in found} == ATTEMPTS


def test_attempts_with_cuts(spark):
    log = guess_log(spark, GAMES)
    tiny = Cutting(sample_rows=100, sample_rows_per_segment=1, smallest_segment=1)
    found = attempts_to_hit(log, "game", "raw", "target", ["ts"], tiny).collect()
    assert {r.game: r.attempts for r in found} == ATTEMPTS


def test_attempts_of_hot_games(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 40).alias("game"),
        F.col("id").alias("ts"),
        (F.xxhash64("id") % 4 != 0).alias("counts"),
        ((F.pmod(F.hash("id"), F.lit(200)) == 0) & ((F.col("id") % 3 > 0) | (F.col("id") > 4000)))
        .alias("hit"),
        ((F.pmod(F.hash("id", F.lit(1)), F.lit(900)) == 0) & (F.col("id") % 3 > 0)).alias("stop"),
    )
    found = attempts_until(rows, ["game"], ["ts"], "counts", "hit", "stop", FINE)
    plain = rows.withColumn(
        "n", F.sum(F.col("counts").cast("long")).over(Window.partitionBy("game").orderBy("ts"))
    ).filter("hit OR stop")
    expected = (
        plain.groupBy("game")
        .agg(F.min_by(F.struct("hit", "n"), "ts").alias("end"))
        .filter("end.hit")
        .select("game", "end.n")
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    attempts = {r.game: r.attempts for r in found.collect()}
    assert len(attempts) > 5 and attempts[-1] > 900


def test_guess_labels(spark):
    labelled = label_guesses(guess_log(spark, {"g": ["10", "30", "20", "x"]}), "raw", "target")
    assert [r.answer for r in labelled.orderBy("ts").collect()] == ["Up", "Down", "hit", "invalid"]
