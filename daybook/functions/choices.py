"""Labels and status codes chosen by fixed rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.numbers import is_blank, to_number

# Subjects, pass mark, labels and status codes.
SUBJECTS = ("HTML", "CSS", "JavaScript")
PASS_MARK = 60
PASSED = "합격"
FAILED = "불합격"
UP = "Up"
DOWN = "Down"
HIT = "hit"
INVALID = "invalid"
NOT_A_NUMBER = "not_a_number"
OUT_OF_RANGE = "out_of_range"
OK = "ok"
CITY_NOT_FOUND = "city_not_found"
WEATHER_UNAVAILABLE = "weather_unavailable"
NO_TEMPERATURE = "no_temperature"


def score_reason(raw: Column, low: float = 0, high: float = 100) -> Column:
    """Why a score is refused, or ``ok``; NULL text stays NULL (nothing was entered)."""
    score = to_number(raw)
    return (
        F.when(raw.isNull(), F.lit(None).cast("string"))
        .when(score.isNull(), NOT_A_NUMBER)
        .when((score < low) | (score > high), OUT_OF_RANGE)
        .otherwise(OK)
    )


def valid_score(raw: Column, low: float = 0, high: float = 100) -> Column:
    """The score, or NULL where it is refused."""
    score = to_number(raw)
    return F.when(score.between(low, high), score)


def guess_number(raw: Column) -> Column:
    """The guessed number; blank counts as zero, other text that is no number gives NULL."""
    return F.coalesce(to_number(raw), F.when(is_blank(raw), 0.0))


def compare_label(guess: Column, target: Column) -> Column:
    """Which way the next guess must go."""
    return (
        F.when(guess > target, DOWN)
        .when(guess < target, UP)
        .when(guess == target, HIT)
        .otherwise(INVALID)
    )


def pass_label(mean: Column) -> Column:
    """Passed or failed."""
    return F.when(mean >= PASS_MARK, PASSED).otherwise(FAILED)


def shown_or_error(value: Column, error: str) -> Column:
    """The value as text, or the error text where there is none."""
    return F.when(value.isNotNull(), value.cast("string")).otherwise(error)


def lookup_status(place: Column, observation: Column, temperature: Column) -> Column:
    """How far a chain of lookups came."""
    return (
        F.when(place.isNull(), CITY_NOT_FOUND)
        .when(observation.isNull(), WEATHER_UNAVAILABLE)
        .when(temperature.isNull(), NO_TEMPERATURE)
        .otherwise(OK)
    )
