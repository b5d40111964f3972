from pyspark.sql import functions as F

from daybook.operators import rules
from daybook.operators.computed import with_computed
from daybook.sources.sales_files import RAW_ROW_SCHEMA, as_accepted, sales_rules

ACCEPTED = [
    ("2024-01", "서울", 1500, "전자"),
    ("2024-01", "부산", 800, "의류"),
    ("2024-02", "대구", 2000, None),
    ("2024-02", "인천", 500, "식품"),
]
REJECTED = [
    ("", "광주", 700, "전자"),
    ("2024-03", "", 300, None),
    ("2024-03", "울산", -100, "의류"),
]


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, RAW_ROW_SCHEMA)


def error(field, message, kind, value, value_type):
    return (
        f"1 validation error for SalesRecord\n{field}\n  {message} [type={kind}, "
        f"input_value={value}, input_type={value_type}]\n    For further information visit "
        f"https://errors.pydantic.dev/2.13/v/{kind}"
    )


ERRORS = [
    error("month", "String should have at least 1 character", "string_too_short", "''", "str"),
    error("region", "String should have at least 1 character", "string_too_short", "''", "str"),
    error("amount", "Input should be greater than 0", "greater_than", "-100", "int"),
]


def test_accept_and_reject(spark):
    good, bad = rules.split(raw_rows(spark, ACCEPTED + REJECTED), sales_rules())
    assert [tuple(r) for r in as_accepted(good).collect()] == [
        (m, r, float(a), c) for m, r, a, c in ACCEPTED
    ]
    report = rules.error_report(bad, "SalesRecord").collect()
    assert [tuple(r.row) for r in report] == REJECTED
    assert [r.error for r in report] == ERRORS


def test_rows_with_nulls_and_several_violations(spark):
    rows = [(None, "", 0, None), ("2024-01", None, None, "x"), ("2024-01", "a", 1, "")]
    frame = raw_rows(spark, rows)
    good, bad = rules.split(frame, sales_rules())
    assert good.count() + bad.count() == frame.count()
    assert good.count() == 1
    found = rules.violation_rows(bad, ["amount"]).orderBy("amount", "field").collect()
    assert [(r.amount, r.field, r.input_value, r.input_type) for r in found] == [
        (None, "amount", "None", "NoneType"),
        (None, "region", "None", "NoneType"),
        (0, "amount", "0", "int"),
        (0, "month", "None", "NoneType"),
        (0, "region", "''", "str"),
    ]
    text = bad.filter("amount = 0").select(rules.error_text("SalesRecord")).first()[0]
    assert text.startswith("3 validation errors for SalesRecord\nmonth\n")


def test_costly_columns_are_computed_once(spark):
    rows = raw_rows(spark, ACCEPTED + REJECTED)
    costly = F.regexp_replace("region", "costly", "")
    once = with_computed(rows, made=costly).filter("made != '' AND made != 'x'")
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("costly") == 1
    assert once.count() == 6
