from pyspark.sql import functions as F

from daybook.functions.messages import (
    GUESS_MESSAGES,
    SCORE_MESSAGES,
    attempts_sentence,
    message_of,
    score_sentence,
    weather_lines,
)


def told(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_score_sentence(spark):
    column = score_sentence(F.col("t"), F.col("m"), F.col("r"))
    rows = [(180.0, 60.0, "합격"), (179.5, 59.75, "불합격")]
    assert told(spark, column, rows, "t double, m double, r string") == [
        "총점: 180점, 평균: 60, 결과: 합격입니다!",
        "총점: 179.5점, 평균: 59.75, 결과: 불합격입니다!",
    ]


def test_attempts_sentence(spark):
    assert told(spark, attempts_sentence(F.col("n")), [(3,)], "n long") == [
        "축하합니다! 3번 만에 맞추셨습니다."
    ]


def test_weather_lines(spark):
    column = weather_lines(F.col("s"), F.col("t"), F.col("h"))
    rows = [("ok", 21.5, 40.0), ("no_temperature", None, 5.0), ("city_not_found", None, None),
            ("weather_unavailable", None, None)]
    assert told(spark, column, rows, "s string, t double, h double") == [
        "🌡️ 온도: 21.5°C\n💧 습도: 40%",
        "날씨 데이터를 불러올 수 없습니다.",
        "도시 정보를 찾을 수 없습니다.",
        "날씨 정보를 불러올 수 없습니다.",
    ]


def test_codes(spark):
    rows = [("not_a_number",), ("out_of_range",), ("ok",), (None,)]
    assert told(spark, message_of(F.col("c"), SCORE_MESSAGES), rows, "c string") == [
        "숫자를 입력해주세요.", "0점부터 100점 사이의 값을 입력해주세요.", None, None
    ]
    assert told(spark, message_of(F.col("c"), GUESS_MESSAGES), [("invalid",)], "c string") == [
        "올바른 숫자를 입력해주세요."
    ]
