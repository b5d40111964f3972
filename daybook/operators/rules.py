"""Named rules over columns: one pass that splits rows into accepted and rejected."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.computed import with_computed

VIOLATIONS = "violations"

# The message formats of the error report.
NON_EMPTY_TYPE = "string_too_short"
NON_EMPTY_MESSAGE = "String should have at least 1 character"
GREATER_THAN_TYPE = "greater_than"
GREATER_THAN_MESSAGE = "Input should be greater than {bound}"
HELP_ADDRESS = "https://errors.pydantic.dev/2.13/v/"
INPUT_TYPE_NAMES = {
    T.StringType: "str",
    T.IntegerType: "int",
    T.LongType: "int",
    T.ShortType: "int",
    T.FloatType: "float",
    T.DoubleType: "float",
    T.BooleanType: "bool",
}

VIOLATION_TYPE = (
    "array<struct<field:string,type:string,message:string,input_value:string,input_type:string>>"
)


@dataclass(frozen=True)
class Rule:
    """A condition on one column. A NULL condition counts as failed."""

    field: str
    type: str
    message: str
    passes: Column


def non_empty(field: str) -> Rule:
    """The text has at least one character."""
    return Rule(field, NON_EMPTY_TYPE, NON_EMPTY_MESSAGE, F.length(field) >= 1)


def greater_than(field: str, bound: int | float) -> Rule:
    """The number is greater than the bound."""
    message = GREATER_THAN_MESSAGE.format(bound=bound)
    return Rule(field, GREATER_THAN_TYPE, message, F.col(field) > bound)


def _input_type(df: DataFrame, field: str) -> Column:
    name = INPUT_TYPE_NAMES.get(type(df.schema[field].dataType), df.schema[field].dataType.simpleString())
    return F.when(F.col(field).isNull(), "NoneType").otherwise(name)


def _input_value(df: DataFrame, field: str) -> Column:
    text = F.col(field).cast("string")
    if isinstance(df.schema[field].dataType, T.StringType):
        text = F.concat(F.lit("'"), text, F.lit("'"))
    return F.coalesce(text, F.lit("None"))


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the array of failed rules, in the order of the rules; empty for a good row."""
    failed = [
        F.when(
            ~F.coalesce(rule.passes, F.lit(False)),
            F.struct(
                F.lit(rule.field).alias("field"),
                F.lit(rule.type).alias("type"),
                F.lit(rule.message).alias("message"),
                _input_value(df, rule.field).alias("input_value"),
                _input_type(df, rule.field).alias("input_type"),
            ),
        )
        for rule in rules
    ]
    violations = F.filter(F.array(*failed), lambda item: item.isNotNull())
    return with_computed(df, **{VIOLATIONS: violations.cast(VIOLATION_TYPE)})


def accepted(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that pass every rule.

    The rules stay plain filters (a filter drops NULL conditions too), so the scan can
    use them.
    """
    for rule in rules:
        df = df.filter(rule.passes)
    return df


def rejected(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that fail some rule, with the failed rules.

    The good rows leave first, so the report is made for the bad ones only.
    """
    passes = reduce(
        lambda a, b: a & b, [F.coalesce(rule.passes, F.lit(False)) for rule in rules]
    )
    return check(df.filter(~passes), rules)


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; together they are the input."""
    return accepted(df, rules), rejected(df, rules)


def violation_rows(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per failed rule."""
    return checked.select(*keys, F.explode(VIOLATIONS).alias("v")).select(*keys, "v.*")


def error_text(model: str, violations: Column | str = VIOLATIONS) -> Column:
    """The failed rules as the text of an error report."""
    found = F.col(violations) if isinstance(violations, str) else violations
    count = F.size(found)
    headline = F.concat(
        count.cast("string"),
        F.when(count == 1, " validation error for ").otherwise(" validation errors for "),
        F.lit(model),
    )
    lines = F.transform(
        found,
        lambda v: F.concat(
            v["field"],
            F.lit("\n  "),
            v["message"],
            F.lit(" [type="),
            v["type"],
            F.lit(", input_value="),
            v["input_value"],
            F.lit(", input_type="),
            v["input_type"],
            F.lit("]\n    For further information visit " + HELP_ADDRESS),
            v["type"],
        ),
    )
    return F.concat_ws("\n", headline, lines)


def error_report(checked: DataFrame, model: str, raw: str = "raw") -> DataFrame:
    """Rejected rows as ``row`` (the values as received) and ``error`` (the text).

    A column with the row's own text stays beside them.
    """
    values = [name for name in checked.columns if name not in (VIOLATIONS, raw)]
    kept = [raw] if raw in checked.columns else []
    return checked.select(
        F.struct(*values).alias("row"), error_text(model).alias("error"), *kept
    )
