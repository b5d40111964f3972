"""Results out of score logs and guess logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.choices import (
    HIT,
    INVALID,
    SUBJECTS,
    compare_label,
    guess_number,
    pass_label,
    valid_score,
)
from daybook.operators.computed import with_computed
from daybook.operators.segments import (
    CUTS_OF_KEY,
    SEGMENT,
    Cutting,
    add_segments,
    earlier_segments,
    segment_window,
)


def first_valid_scores(
    log: DataFrame, student: str, subject: str, raw: str, order: Sequence[str]
) -> DataFrame:
    """Per student and subject the first valid score, its place, and the first cancel.

    A cancel is a row without text. Both come out of one aggregate, so each task sends one
    row per group.
    """
    place = F.struct(*order)
    scored = with_computed(log, _score=valid_score(F.col(raw)))
    is_valid = F.col("_score").isNotNull()
    return scored.groupBy(student, subject).agg(
        F.min_by("_score", F.when(is_valid, place)).alias("score"),
        F.min(F.when(is_valid, place)).alias("entered"),
        F.min(F.when(F.col(raw).isNull(), place)).alias("cancelled"),
    )


def score_results(
    log: DataFrame,
    student: str,
    subject: str,
    raw: str,
    order: Sequence[str],
    subjects: Sequence[str] = SUBJECTS,
) -> DataFrame:
    """Total, mean and label per student with a valid score in every subject.

    The scores are added in the order of the subjects. A student who cancels before the last
    score has no result.
    """
    firsts = first_valid_scores(
        log.filter(F.col(subject).isin(*subjects)), student, subject, raw, order
    )
    per_subject = [
        F.max(F.when(F.col(subject) == name, F.col("score"))).alias(f"_score{i}")
        for i, name in enumerate(subjects)
    ]
    per_student = firsts.groupBy(student).agg(
        *per_subject, F.max("entered").alias("_done"), F.min("cancelled").alias("_cancelled")
    )
    total = reduce(lambda a, b: a + b, [F.col(f"_score{i}") for i in range(len(subjects))])
    return (
        per_student.withColumn("total", total)
        .filter(F.col("total").isNotNull())
        .filter(F.col("_cancelled").isNull() | (F.col("_done") < F.col("_cancelled")))
        .withColumn("mean", F.col("total") / len(subjects))
        .select(student, "total", "mean", pass_label(F.col("mean")).alias("result"))
    )


def label_guesses(log: DataFrame, raw: str, target: str) -> DataFrame:
    """Add the guessed number and the answer to each guess."""
    guessed = with_computed(log, guess=guess_number(F.col(raw)))
    return guessed.withColumn("answer", compare_label(F.col("guess"), F.col(target)))


def attempts_until(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counts: str,
    hit: str,
    stop: str | None = None,
    cutting: Cutting = Cutting(),
    cut_from: DataFrame | None = None,
) -> DataFrame:
    """Per key the number of counting rows up to and including the first hit.

    ``counts``, ``hit`` and ``stop`` name boolean columns; a key that stops before its first
    hit, or has none, gives no row.
    """
    stops = F.coalesce(F.col(stop), F.lit(False)) if stop else F.lit(False)
    relevant = rows.select(
        *keys,
        *order,
        F.coalesce(F.col(counts), F.lit(False)).alias("_counts"),
        F.coalesce(F.col(hit), F.lit(False)).alias("_hit"),
        stops.alias("_stops"),
    ).filter("_counts OR _hit OR _stops")
    places = rows if cut_from is None else cut_from
    cut = add_segments(relevant, keys, order, cutting, places).drop(CUTS_OF_KEY)
    place = F.struct(*order)
    ends = F.when(F.col("_hit") | F.col("_stops"), place)
    running = cut.withColumn(
        "_tries", F.sum(F.col("_counts").cast("long")).over(segment_window(keys, order))
    )
    per_segment = running.groupBy(*keys, SEGMENT).agg(
        F.max("_tries").alias("_tries"),
        F.min_by(F.struct("_hit", "_tries"), ends).alias("_end"),
    )
    counted = per_segment.withColumn(
        "_before", F.coalesce(F.sum("_tries").over(earlier_segments(keys)), F.lit(0))
    )
    return (
        counted.filter("_end IS NOT NULL")
        .groupBy(*keys)
        .agg(
            F.min_by(
                F.struct("_end._hit", (F.col("_end._tries") + F.col("_before")).alias("attempts")),
                SEGMENT,
            ).alias("_first")
        )
        .filter("_first._hit")
        .select(*keys, F.col("_first.attempts").alias("attempts"))
    )


def attempts_to_hit(
    log: DataFrame,
    game: str,
    raw: str,
    target: str,
    order: Sequence[str],
    cutting: Cutting = Cutting(),
) -> DataFrame:
    """Per game the number of valid guesses up to the hit; a row without text ends a game."""
    labelled = label_guesses(log, raw, target).select(
        game,
        *order,
        (F.col("answer") != INVALID).alias("_valid"),
        (F.col("answer") == HIT).alias("_is_hit"),
        F.col(raw).isNull().alias("_cancel"),
    )
    return attempts_until(labelled, [game], order, "_valid", "_is_hit", "_cancel", cutting, log)
