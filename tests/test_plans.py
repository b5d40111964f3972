"""What the plans must show: pruned scans, pushed filters, partial aggregates, no Python."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.plans import queries
from daybook.plans.queries import QUERIES
from daybook.plans.tables import submission_urls, table

SF_DIR = "/root/testdata/sf0.001"
STREAMS = {"last_choice_stream", "late_choice_stream", "enriched_stream"}


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_filter_reaches_the_scan(spark):
    assert "GreaterThan(c_acctbal,0.0)" in plan(spark, "accepted_rows")


@pytest.mark.parametrize(
    "name, columns",
    [
        ("payload_fields", {"event_id", "props"}),
        ("last_choice", {"event_id", "ts", "user_id", "event_type"}),
        ("query_params", {"page_id", "url"}),
        ("page_items", {"page_id", "html"}),
        ("current_value", {"event_id", "ts", "user_id", "event_type", "value"}),
    ],
)
def test_scan_reads_only_needed_columns(spark, name, columns):
    found = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name))
    assert [{field.split(":")[0] for field in schema.split(",")} for schema in found] == [columns]


@pytest.mark.parametrize("name", ["last_choice", "first_match", "inlinks", "sales_by_region"])
def test_aggregates_start_before_the_shuffle(spark, name):
    assert re.search(r"Exchange hashpartitioning.*\n.*Aggregate\(.*partial_", plan(spark, name))


@pytest.mark.parametrize(
    "name",
    ["accepted_rows", "rejected_rows", "page_links", "page_items", "schedule_lines", "table_slots",
     "query_params", "form_violations"],
)
def test_row_work_does_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_narrow_rows_go_to_many_tasks(spark, tmp_path):
    """A file of few bytes is one split, whatever is made of its rows."""
    keys = spark.range(30_000).repartition(1)
    people = keys.select(F.col("id").alias("c_custkey"), F.lit("Customer").alias("c_name"))
    people.write.parquet(str(tmp_path / "customer.parquet"))
    customer = table(spark, str(tmp_path), "customer")
    urls = submission_urls(customer)
    tasks = [row["count"] for row in urls.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 30_000 and len(tasks) > 8 and max(tasks) < 5_000


def test_page_files_stand_in_folders_of_few(spark, tmp_path):
    """One folder of all files is put in place and listed by the driver alone."""
    html = F.when(F.col("id") % 5 != 0, F.concat(F.lit("<html lang=en><title>"), F.lit("t"), F.lit("</title>x\ny")))
    rows = spark.range(2_500).select(F.col("id").alias("page_id"), html.alias("html"))
    rows.repartition(1).write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.page_files(spark, str(tmp_path))
    folders = Counter(name.rsplit("/", 1)[0] for name in found.inputFiles())
    assert sum(folders.values()) == 2_500 and len(folders) > 1 and max(folders.values()) < 2_000
    facts = Counter((row.lang, row.title, row.chars) for row in found.collect())
    assert facts == {("en", "t", 33): 2_000, (None, None, 0): 500}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1
