"""Sales records in files: JSON arrays, assignment-prefixed arrays, CSV, reject reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.rules import (
    VIOLATIONS,
    Rule,
    check,
    error_report,
    greater_than,
    non_empty,
)
from daybook.session import shared_folder

SALES_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("month", T.StringType()),
    ]
)
ACCEPTED_SCHEMA = T.StructType(
    [
        T.StructField("month", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("category", T.StringType()),
    ]
)
RAW_ROW_SCHEMA = T.StructType(
    [
        T.StructField("month", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("category", T.StringType()),
    ]
)
REJECT_SCHEMA = T.StructType(
    [T.StructField("row", RAW_ROW_SCHEMA), T.StructField("error", T.StringType())]
)

RAW = "raw"
CSV_CELLS = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# What the reader takes an unquoted empty cell for; no cell can hold it.
NO_CELL = "\x00"
SALES_MODEL = "SalesRecord"
_ACCEPTED = "_accepted"
ASSIGNMENT_PREFIX = r"^\s*[A-Za-z_]\w*\s*=\s*"


def sales_rules() -> list[Rule]:
    """What makes a sales record valid; the category is optional."""
    return [non_empty("month"), non_empty("region"), greater_than("amount", 0)]


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType = SALES_SCHEMA
) -> DataFrame:
    """Files that hold one JSON array each. A broken file fails the read."""
    return (
        spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    )


def read_assigned_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType = SALES_SCHEMA
) -> DataFrame:
    """Files that hold ``name = [ ... ]``. A broken file fails the read."""
    array = F.from_json(
        F.regexp_replace("value", ASSIGNMENT_PREFIX, ""),
        T.ArrayType(schema),
        {"mode": "FAILFAST"},
    )
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(array).alias("record"))
        .select("record.*")
    )


def read_raw_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_ROW_SCHEMA
) -> DataFrame:
    """Array files, with or without assignment prefix, keeping each record's own text.

    A value of the wrong kind becomes NULL, to be refused by the rules instead of failing the
    read; ``raw`` still has it, and tells a missing key from a NULL.
    """
    texts = F.from_json(
        F.regexp_replace("value", ASSIGNMENT_PREFIX, ""), "array<string>", {"mode": "FAILFAST"}
    )
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(texts).alias(RAW))
        .withColumn("record", F.from_json(RAW, schema))
        .select("record.*", RAW)
    )


def read_array_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType = SALES_SCHEMA
) -> DataFrame:
    """Arrays with whole records on each line, with or without an assignment prefix.

    Only for files of that layout; a line may hold several records, and a record that goes on
    in the next line fails the read. Their lines can be read by many tasks, so one file may be
    of any size; the other two readers take a whole file into one task.
    """
    line = F.regexp_replace(F.regexp_replace("value", r"^\s*(?:\[\s*(?=\{))?", ""), r"[\s,\]]+$", "")
    body = F.regexp_replace(line, r"^[A-Za-z_]\w*\s*=\s*\[?\s*", "")
    records = F.from_json(
        F.concat(F.lit("["), "body", F.lit("]")), T.ArrayType(schema), {"mode": "FAILFAST"}
    )
    return (
        spark.read.text(path)
        .select(body.alias("body"))
        .filter(~F.col("body").isin("", "["))
        .select(F.explode(records).alias("record"))
        .select("record.*")
    )


def as_accepted(rows: DataFrame) -> DataFrame:
    """Valid records with the amount as double, in the column order of the CSV file."""
    return rows.select("month", "region", F.col("amount").cast("double").alias("amount"), "category")


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV files with a header and CRLF line ends; a NULL is an empty cell.

    Blanks stay, quotes are doubled, and an empty text is a quoted empty cell. A line break
    in a cell fails the write: files whose lines are records can be read by many tasks.
    """
    broken = F.raise_error(F.lit("a line break in a cell of a CSV file"))
    cells = [
        F.when(F.col(field.name).rlike(r"[\r\n]"), broken.cast("string"))
        .otherwise(F.col(field.name))
        .alias(field.name)
        if isinstance(field.dataType, T.StringType)
        else F.col(field.name)
        for field in rows.schema
    ]
    (
        rows.select(*cells)
        .write.option("header", True)
        .option("lineSep", "\r\n")
        .options(**CSV_CELLS)
        .option("emptyValue", '""')
        .csv(path)
    )


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType = ACCEPTED_SCHEMA
) -> DataFrame:
    """CSV files with a header and CRLF line ends, as `write_csv` leaves them."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("lineSep", "\r\n")
        .options(**CSV_CELLS)
        .option("nullValue", NO_CELL)
        .option("emptyValue", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_rejects(report: DataFrame, path: str) -> None:
    """Reject report as JSON lines.

    With the record's own text the row is written as it was received, else keys without a
    value are left out.
    """
    if RAW not in report.columns:
        report.select("row", "error").write.json(path)
        return
    line = F.concat(
        F.lit('{"row":'),
        F.regexp_replace(RAW, r"[\r\n]+", " "),
        F.lit(","),
        F.substring(F.to_json(F.struct("error")), 2, 2**31 - 1),
    )
    report.select(line.alias("value")).write.text(path)


def read_rejects(
    spark: SparkSession, path: str | list[str], array_files: bool = False
) -> DataFrame:
    """Reject reports, as JSON lines or as files of one JSON array each."""
    return (
        spark.read.schema(REJECT_SCHEMA)
        .option("multiLine", array_files)
        .option("mode", "FAILFAST")
        .json(path)
    )


def write_accepted(rows: DataFrame, rules: Sequence[Rule], path: str) -> None:
    """Write the accepted sales records."""
    checked = check(rows, rules)
    write_csv(as_accepted(checked.filter(F.size(VIOLATIONS) == 0)), path)


def write_rejected(
    rows: DataFrame, rules: Sequence[Rule], path: str, model: str = SALES_MODEL
) -> None:
    """Write the report of the rejected sales records."""
    checked = check(rows, rules)
    write_rejects(error_report(checked.filter(F.size(VIOLATIONS) > 0), model), path)


def write_split(
    rows: DataFrame,
    rules: Sequence[Rule],
    accepted_path: str,
    rejected_path: str,
    model: str = SALES_MODEL,
) -> None:
    """Check sales records and write the accepted and the rejected ones.

    The source is read and checked once: the checked records are kept in the shared folder,
    parted by their status, and each sink reads its own part.
    """
    folder = shared_folder(rows.sparkSession, "split")
    checked = check(rows, rules).withColumn(_ACCEPTED, F.size(VIOLATIONS) == 0)
    checked.write.partitionBy(_ACCEPTED).parquet(folder)
    kept = rows.sparkSession.read.schema(checked.schema).parquet(folder)
    write_csv(as_accepted(kept.filter(_ACCEPTED)), accepted_path)
    bad = kept.filter(~F.col(_ACCEPTED)).drop(_ACCEPTED)
    write_rejects(error_report(bad, model), rejected_path)
