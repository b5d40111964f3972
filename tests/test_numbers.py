import pytest
from pyspark.sql import functions as F

from daybook.functions.choices import (
    compare_label,
    guess_number,
    pass_label,
    score_reason,
    shown_or_error,
    valid_score,
)
from daybook.functions.numbers import (
    fixed_decimals,
    integer_between,
    is_number,
    number_text,
    random_integer,
    to_number,
    trimmed,
)
from daybook.functions.texts import form_length, form_length_between


def value_of(spark, column, raw, kind="string"):
    return spark.createDataFrame([(raw,)], f"raw {kind}").select(column(F.col("raw"))).first()[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("7", 7.0),
        (" 7.5\t", 7.5),
        ("　-3﻿", -3.0),
        ("+5", 5.0),
        ("1.", 1.0),
        (".5", 0.5),
        ("1e3", 1000.0),
        ("0x1F", 31.0),
        ("0b101", 5.0),
        ("0o17", 15.0),
        ("-Infinity", float("-inf")),
        ("1d", None),
        ("1f", None),
        ("NaN", None),
        ("inf", None),
        ("1 2", None),
        ("-0x1", None),
        ("0b2", None),
        ("", None),
        ("  ", None),
        (None, None),
    ],
)
def test_to_number(spark, raw, expected):
    assert value_of(spark, to_number, raw) == expected
    assert value_of(spark, is_number, raw) == (expected is not None)


@pytest.mark.parametrize(
    "raw, reason",
    [
        ("60", "ok"),
        ("0", "ok"),
        ("100", "ok"),
        ("abc", "not_a_number"),
        ("", "not_a_number"),
        ("  ", "not_a_number"),
        ("1d", "not_a_number"),
        ("-1", "out_of_range"),
        ("100.5", "out_of_range"),
        ("1e3", "out_of_range"),
        ("Infinity", "out_of_range"),
        (None, None),
    ],
)
def test_score_reason(spark, raw, reason):
    assert value_of(spark, score_reason, raw) == reason
    assert (value_of(spark, valid_score, raw) is not None) == (reason == "ok")


def test_guess_counts_blank_as_zero(spark):
    assert value_of(spark, guess_number, "") == 0.0
    assert value_of(spark, guess_number, " \n") == 0.0
    assert value_of(spark, guess_number, "x") is None
    assert value_of(spark, guess_number, None) is None


def test_labels(spark):
    def label(guess):
        return value_of(spark, lambda c: compare_label(c, F.lit(20)), guess, "double")

    assert [label(g) for g in (10.0, 30.0, 20.0, None)] == ["Up", "Down", "hit", "invalid"]
    assert value_of(spark, pass_label, 60.0, "double") == "합격"
    assert value_of(spark, pass_label, 59.99, "double") == "불합격"
    assert value_of(spark, lambda c: shown_or_error(c, "none"), None, "double") == "none"
    assert value_of(spark, lambda c: shown_or_error(c, "none"), 2.5, "double") == "2.5"


@pytest.mark.parametrize(
    "value, text",
    [(0.0001, "0.0001"), (12345678.9, "12345678.9"), (60.0, "60"), (1e20, "100000000000000000000"),
     (1e21, "1e+21"), (1.5e-7, "1.5e-7"), (-0.00025, "-0.00025"), (1e7, "10000000"), (None, None)],
)
def test_number_text(spark, value, text):
    assert value_of(spark, number_text, value, "double") == text


def test_long_radix_numbers(spark):
    assert value_of(spark, to_number, "0x" + "0" * 30 + "5") == 5.0
    assert value_of(spark, to_number, "0x1" + "0" * 16) == 2.0**64
    assert value_of(spark, to_number, " 0b" + "1" * 70 + " ") == float(2**70 - 1)
    assert value_of(spark, to_number, "0o0") == 0.0
    assert value_of(spark, to_number, "0x") is None


def test_formats(spark):
    assert value_of(spark, fixed_decimals, 37.566, "double") == "37.5660"
    assert value_of(spark, fixed_decimals, None, "double") is None
    assert value_of(spark, trimmed, "\t a b  ") == "a b"


def test_lengths_count_utf16_units(spark):
    assert value_of(spark, form_length, "🌀a") == 3
    assert value_of(spark, form_length, "a\r\nb") == 3
    assert value_of(spark, lambda c: form_length_between(c, 4, 15), "abcd") is True
    assert value_of(spark, lambda c: form_length_between(c, 4, 15), None) is None


def test_integers_stay_in_range(spark):
    keys = spark.range(5000)
    fixed = keys.select(integer_between(F.col("id"), 1, 50).alias("n"))
    assert fixed.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 50, 50)
    drawn = keys.select(random_integer(1, 50, 3).alias("n"))
    assert drawn.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 50, 50)
