"""Results told as sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.choices import (
    CITY_NOT_FOUND,
    INVALID,
    NO_TEMPERATURE,
    NOT_A_NUMBER,
    OUT_OF_RANGE,
    WEATHER_UNAVAILABLE,
)
from daybook.functions.numbers import number_text

# The sentences.
STATUS_MESSAGES = {
    CITY_NOT_FOUND: "도시 정보를 찾을 수 없습니다.",
    WEATHER_UNAVAILABLE: "날씨 정보를 불러올 수 없습니다.",
    NO_TEMPERATURE: "날씨 데이터를 불러올 수 없습니다.",
}
SCORE_MESSAGES = {
    NOT_A_NUMBER: "숫자를 입력해주세요.",
    OUT_OF_RANGE: "0점부터 100점 사이의 값을 입력해주세요.",
}
GUESS_MESSAGES = {INVALID: "올바른 숫자를 입력해주세요."}
SCORE_RESULT = "총점: %s점, 평균: %s, 결과: %s입니다!"
ATTEMPTS_RESULT = "축하합니다! %s번 만에 맞추셨습니다."
WEATHER_LINES = "🌡️ 온도: %s°C\n💧 습도: %s%%"


def message_of(code: Column, messages: dict[str, str]) -> Column:
    """The sentence of a code; NULL where there is nothing to say."""
    told = F.lit(None).cast("string")
    for name, text in messages.items():
        told = F.when(code == name, text).otherwise(told)
    return told


def score_sentence(total: Column, mean: Column, result: Column) -> Column:
    """Total, mean and label as a sentence."""
    return F.format_string(SCORE_RESULT, number_text(total), number_text(mean), result)


def attempts_sentence(attempts: Column) -> Column:
    """The number of attempts as a sentence."""
    return F.format_string(ATTEMPTS_RESULT, attempts.cast("string"))


def weather_lines(status: Column, temperature: Column, humidity: Column) -> Column:
    """Temperature and humidity as two lines, or why they are missing."""
    lines = F.format_string(WEATHER_LINES, number_text(temperature), number_text(humidity))
    return F.coalesce(message_of(status, STATUS_MESSAGES), lines)
