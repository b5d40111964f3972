"""The registered queries. Each takes a session and the folder of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.choices import score_reason, valid_score
from daybook.functions.messages import (
    SCORE_MESSAGES,
    attempts_sentence,
    message_of,
    score_sentence,
    weather_lines,
)
from daybook.functions.numbers import integer_between
from daybook.operators import forms, global_order, pages, rules, sales, sketches, snapshots
from daybook.operators.computed import spread
from daybook.operators.intervals import interval_join
from daybook.operators.latest import latest_value
from daybook.operators.lookups import (
    Salting,
    as_of_lookup,
    current_value,
    first_match,
    label_lookup,
    lookup_join,
    with_status,
)
from daybook.operators.scores import (
    attempts_to_hit,
    attempts_until,
    label_guesses,
    score_results,
)
from daybook.operators.segments import Cutting
from daybook.operators.skewed_joins import counted, skewed_join
from daybook.operators.texts import LINES_PER_PART, item_line, ordered_text
from daybook.plans.tables import (
    customer_pages,
    event_counter,
    part_pages,
    sales_records,
    submission_urls,
    table,
)
from daybook.session import saved_table, shared_folder
from daybook.sources.literals import CITIES, code_table, item_table
from daybook.sources.page_files import read_pages
from daybook.sources.payloads import with_coordinates, with_weather
from daybook.sources.query_strings import param_rows
from daybook.sources.sales_files import (
    RAW_ROW_SCHEMA,
    read_array_lines,
    read_assigned_array,
    read_csv,
    read_json_array,
    read_rejects,
    sales_rules,
    write_accepted,
    write_rejected,
    write_split,
)
from daybook.sources.split_arrays import read_split_array
from daybook.streaming.as_of import run_as_of
from daybook.streaming.choices import change_events, run_enriched, run_latest_choice
from daybook.streaming.quiet_keys import run_latest_choice_of_active_keys
from daybook.streaming.windows import run_gate, run_windows

MISSING_FROM = 100
CITY_COUNT = 25
ARRIVALS = 4
CALENDAR_MONTHS = [f"{month:02d}" for month in range(1, 13)]


# Rules


def customer_rules() -> list[rules.Rule]:
    return [rules.non_empty("c_name"), rules.greater_than("c_acctbal", 0)]


def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = rules.accepted(table(spark, sf_dir, "customer"), customer_rules())
    return good.select(
        "c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("amount"), "c_mktsegment"
    )


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rules.rejected(table(spark, sf_dir, "customer"), customer_rules())
    return rules.violation_rows(bad, ["c_custkey"])


def error_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    report = rules.error_report(rules.rejected(rows, customer_rules()), "Customer")
    return report.select("row.c_custkey", "error")


def score_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value").cast("string")
    raw = F.expr(
        "CASE event_id % 13 WHEN 0 THEN '' WHEN 1 THEN '\t ' WHEN 2 THEN '1d' WHEN 3 THEN '-1' "
        "WHEN 4 THEN NULL WHEN 5 THEN '0x00000000000000000005' WHEN 6 THEN '0x10000000000000000' "
        "WHEN 7 THEN concat('0b', repeat('0', 70), '101') WHEN 8 THEN '0o17' END"
    )
    entered = F.when(F.col("event_id") % 13 < 9, raw).otherwise(F.concat(F.lit(" "), value))
    reason = score_reason(entered)
    return table(spark, sf_dir, "events").select(
        "event_id",
        reason.alias("reason"),
        valid_score(entered).alias("score"),
        message_of(reason, SCORE_MESSAGES).alias("told"),
    )


def _raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw sales rows, some without month, region or category, some not positive.

    Some regions have blanks at their ends, are blank, or hold quotes and commas.
    """
    key = F.col("c_custkey")
    region = (
        F.when(key % 23 == 1, "  a ")
        .when(key % 23 == 2, " ")
        .when(key % 23 == 3, 'say "x", y')
        .otherwise(F.col("c_name"))
    )
    category = F.when(key % 7 == 1, "").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        F.when(key % 17 == 0, "").otherwise(F.concat(F.lit("2024-"), F.lpad(key % 12 + 1, 2, "0")))
        .alias("month"),
        F.when(key % 19 != 0, region).alias("region"),
        F.floor("c_acctbal").cast("long").alias("amount"),
        F.when(key % 5 != 0, category).alias("category"),
    )


def written_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "accepted")
    write_accepted(_raw_sales(spark, sf_dir), sales_rules(), path)
    return read_csv(spark, path)


def written_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "rejected")
    write_rejected(_raw_sales(spark, sf_dir), sales_rules(), path)
    return read_rejects(spark, path).select("row.*", "error")


def written_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both files of a split, as one table."""
    good, bad = (shared_folder(spark, name) for name in ("accepted", "rejected"))
    write_split(_raw_sales(spark, sf_dir), sales_rules(), good, bad)
    accepted = read_csv(spark, good).withColumn("error", F.lit(None).cast("string"))
    rejected = read_rejects(spark, bad).select("row.*", "error")
    return accepted.unionByName(rejected.withColumn("amount", F.col("amount").cast("double")))


def _array_files(spark: SparkSession, sf_dir: str, prefix: str, per_line: int) -> str:
    """Raw sales rows as array files: one array per file, or whole records on each line."""
    path = shared_folder(spark, "arrays")
    rows = _raw_sales(spark, sf_dir).select(
        F.monotonically_increasing_id().alias("nr"), F.to_json(F.struct("*")).alias("record")
    )
    grouped = rows.groupBy(F.floor(F.col("nr") / per_line)).agg(
        F.array_join(F.collect_list("record"), ", ").alias("records")
    )
    writer = grouped.select(
        F.concat(F.lit(prefix), "records", F.lit("," if not prefix else "]")).alias("value")
    ).write
    (writer.option("maxRecordsPerFile", 1) if prefix else writer).text(path)
    return path


def json_array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json_array(spark, _array_files(spark, sf_dir, "[", 1000))


def assigned_array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_assigned_array(spark, _array_files(spark, sf_dir, "sales = [", 1000))


def array_line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_array_lines(spark, _array_files(spark, sf_dir, "", 3))


#: Ranges so small that the files of small tables, too, are cut.
FINE_RANGES = 48 << 10


def split_array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _array_files(spark, sf_dir, "sales = [", 1000)
    return read_split_array(spark, path, RAW_ROW_SCHEMA, FINE_RANGES)


def secret_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", integer_between(F.col("c_custkey"), 1, 50).alias("secret")
    )


def form_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = forms.read_submissions(submission_urls(table(spark, sf_dir, "customer")), "url")
    bad = rules.rejected(sent, forms.form_rules())
    return rules.violation_rows(bad, ["c_custkey"]).select("c_custkey", "field", "type")


def form_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = forms.read_submissions(submission_urls(table(spark, sf_dir, "customer")), "url")
    return sent.select(
        "c_custkey",
        F.col("userId").alias("user_id"),
        F.col("userPw_len").alias("password_length"),
        F.col("userName").alias("user_name"),
        F.date_format("userBirth", "yyyy-MM-dd").alias("birth"),
        "gender",
        F.array_join("interest", ",").alias("interests"),
        F.col("joinPath").alias("join_path"),
        F.length("intro").alias("intro_length"),
    )


# Sources


def payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k")
    )


def payload_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 == 0, '{"results":[]}')
        .when(F.col("c_custkey") % 5 == 1, "{}")
        .otherwise(
            F.concat(
                F.lit('{"results":[{"name":"x","latitude":'),
                F.col("c_acctbal").cast("string"),
                F.lit(',"longitude":'),
                F.col("c_nationkey").cast("string"),
                F.lit('},{"latitude":1,"longitude":2}]}'),
            )
        )
        .alias("geo"),
        F.concat(
            F.lit('{"current":{"temperature_2m":'),
            F.when(F.col("c_custkey") % 3 == 0, "null").otherwise(F.col("c_acctbal").cast("string")),
            F.lit(',"relative_humidity_2m":55}}'),
        ).alias("weather"),
    )
    return with_weather(with_coordinates(answers, "geo"), "weather").drop("geo", "weather")


def query_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return param_rows(table(spark, sf_dir, "pages"), "page_id", "url")


# Lookups


#: Sizes at which small tables, too, have segments and salted keys.
FINE_CUTTING = Cutting(sample_rows=5000, sample_rows_per_segment=4, smallest_segment=8)
FINE_SALTING = Salting(sample_rows=5000, sample_rows_per_part=4, smallest_table=8)


def label_lookup_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    found = lookup_join(customer, nation, ["c_nationkey"], broadcast_rows=0, salting=FINE_SALTING)
    return found.select("c_custkey", "nation")


def label_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = label_lookup(
        table(spark, sf_dir, "nation"),
        "n_regionkey",
        table(spark, sf_dir, "region"),
        "r_regionkey",
        "r_name",
        "region",
    ).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"), "region")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lookup_join(customer, nation, ["c_nationkey"]).select("c_custkey", "nation", "region")


def city_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.expr("element_at(array('Seoul', 'Busan', 'Gwangju', 'Daejeon', 'Jeju'), "
                  "cast(user_id % 5 + 1 AS int))")
    chosen = table(spark, sf_dir, "events").select("event_id", code.alias("city"))
    return chosen.join(code_table(spark, CITIES, "city", "label"), "city", "left").select(
        "event_id", "city", "label"
    )


#: What an event of each type counts.
POINTS = [("click", 1), ("view", 2), ("purchase", 25), ("signup", 10), ("refund", -25)]


def literal_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of each user out of a literal table, the types in the order of the literal."""
    points = F.broadcast(item_table(spark, POINTS, "event_type string, points int"))
    counted = table(spark, sf_dir, "events").join(points, "event_type")
    return counted.groupBy("user_id", "pos", "event_type").agg(F.sum("points").alias("points"))


def first_match_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    candidates = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_acctbal"
    )
    rank = [-F.col("c_acctbal"), F.col("c_custkey")]
    return first_match(nation, candidates, ["n_nationkey"], rank).select(
        "n_nationkey", "n_name", "match.c_custkey", "match.c_acctbal"
    )


def _clicks_with_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("click", "view"))
        .select("event_id", "user_id", "ts", "event_type", "value")
    )
    found = current_value(
        events,
        ["user_id"],
        ["ts", "event_id"],
        F.col("event_type") == "view",
        ["value"],
        "observed",
        cut_from=table(spark, sf_dir, "events"),
    )
    return found.filter(F.col("event_type") == "click")


def current_value_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks_with_view(spark, sf_dir).select(
        "event_id", "user_id", F.col("observed.value").alias("view_value")
    )


def observed_value_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_value(spark, sf_dir, FINE_CUTTING)


def observed_value(
    spark: SparkSession, sf_dir: str, cutting: Cutting = Cutting()
) -> DataFrame:
    events = table(spark, sf_dir, "events")
    clicks = events.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    views = events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), "user_id", "ts", "value"
    )
    found = as_of_lookup(
        clicks,
        views,
        ["user_id"],
        "ts",
        "event_id",
        "view_id",
        ["view_id", "value"],
        "observed",
        cutting,
    )
    return found.select("event_id", "user_id", "observed.view_id", "observed.value")


def _cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities: the label of each, and the first of its places; NULL without any.

    Places are the accepted customers; every sixth nation has none.
    """
    cities = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("city"), F.col("n_name").alias("label")
    )
    places = (
        rules.accepted(table(spark, sf_dir, "customer"), customer_rules())
        .filter(F.col("c_nationkey") % 6 != 5)
        .select(
            F.col("c_nationkey").cast("long").alias("city"),
            F.col("c_custkey").alias("station"),
            F.col("c_acctbal").alias("latitude"),
            F.col("c_nationkey").cast("double").alias("longitude"),
        )
    )
    return first_match(cities, places, ["city"], [F.col("station")], "place")


def enriched_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain: the city's first place, then the observation of the station that it names."""
    events = table(spark, sf_dir, "events")
    chosen = events.filter(F.col("event_type") == "click").select(
        "event_id", "user_id", "ts", (F.col("user_id") % CITY_COUNT).alias("city")
    )
    placed = lookup_join(chosen, _cities(spark, sf_dir), ["city"], size_from=table(spark, sf_dir, "nation"))
    # A row without a place gets a station of its own, which has no observation: such rows
    # spread over the tasks.
    asked = placed.withColumn("station", F.coalesce("place.station", -F.col("event_id")))
    views = events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"),
        F.col("user_id").alias("station"),
        "ts",
        F.when(F.col("value") < MISSING_FROM, F.col("value")).alias("temperature"),
    )
    observed = as_of_lookup(
        asked, views, ["station"], "ts", "event_id", "view_id", ["view_id", "temperature"], "observed"
    )
    known = observed.select(
        "event_id", "user_id", "label", "place", "observed", "observed.temperature",
        "place.latitude", "place.longitude",
    )
    told = with_status(known, "place", "observed", "temperature", "latitude", "longitude")
    return told.select(
        "event_id",
        "user_id",
        "label",
        "status",
        "latitude_text",
        "longitude_text",
        "temperature",
        weather_lines(F.col("status"), F.col("temperature"), F.col("longitude")).alias("told"),
    )


# Joins of large tables


def _skewed_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events and suppliers with a key that a third of both have, and NULL keys."""

    def key(number: str, others: int):
        return F.when(F.col(number) % 3 == 0, 0).when(F.col(number) % 7 != 1, F.col(number) % others)

    events = table(spark, sf_dir, "events").select(key("event_id", 400).alias("k"), "event_id", "event_type")
    suppliers = table(spark, sf_dir, "supplier").select(key("s_suppkey", 300).alias("k"), "s_suppkey", "s_nationkey")
    return events, suppliers


def skewed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, suppliers = _skewed_sides(spark, sf_dir)
    joined = skewed_join(
        counted(events, ["k", "event_type"], events=F.count("*")),
        counted(suppliers, ["k", "s_nationkey"], suppliers=F.count("*")),
        ["k"],
        salting=FINE_SALTING,
    )
    pairs = F.sum(F.col("events") * F.col("suppliers")).alias("pairs")
    return joined.groupBy("event_type", "s_nationkey").agg(pairs)


def skewed_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A side without a partner has no number, and stands in one row for each of the other's."""
    events, suppliers = _skewed_sides(spark, sf_dir)
    joined = skewed_join(
        counted(events, ["k"], known=F.count("event_id"), events=F.count("*")),
        counted(suppliers, ["k", "s_suppkey"], suppliers=F.count("*")),
        ["k"],
        "full",
        FINE_SALTING,
    )
    left, known, right = (F.coalesce(x, F.lit(y)) for x, y in (("events", 1), ("known", 0), ("suppliers", 1)))
    return joined.groupBy("k", "s_suppkey").agg(
        F.sum(known * right).alias("events"), F.sum(left * right).alias("rows")
    )


def skewed_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with and without a supplier."""
    sides = _skewed_sides(spark, sf_dir)
    parts = [
        skewed_join(*sides, ["k"], how, FINE_SALTING).select("event_id", F.lit(how).alias("kind"))
        for how in ("semi", "anti")
    ]
    return parts[0].unionByName(parts[1])


def interval_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of an hour and views of up to three hours of the same user that overlap."""
    events = table(spark, sf_dir, "events").withColumn("begin", F.unix_timestamp(F.col("ts").cast("timestamp")))
    clicks = events.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("begin").alias("c_from"), (F.col("begin") + 3600).alias("c_to")
    )
    views = events.filter(F.col("event_type") == "view").select(
        "user_id",
        F.col("event_id").alias("view_id"),
        F.col("begin").alias("v_from"),
        (F.col("begin") + F.col("event_id") % 4 * 3600).alias("v_to"),
    )
    found = interval_join(
        clicks, views, ["user_id"], ("c_from", "c_to"), ("v_from", "v_to"), 3600, FINE_SALTING
    )
    return found.select("user_id", "click_id", "view_id")


# The order of a whole table

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").alias("price")
    return table(spark, sf_dir, "lineitem").select(price, *_LINE)


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_order.row_numbers(_lines(spark, sf_dir), ["price", *_LINE], "number", FINE_CUTTING)


def line_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_order.tiles(_lines(spark, sf_dir), ["price", *_LINE], 7, "tile", FINE_CUTTING)


def quantity_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks by a value that very many rows share, and the running total of another."""
    lines = _lines(spark, sf_dir).withColumn("amount", F.col("price").cast("decimal(18,2)"))
    ranked = global_order.ranked_rows(lines, ["l_quantity"], "amount", FINE_CUTTING, FINE_SALTING)
    return ranked.withColumn("total", F.col("total").cast("double")).drop("amount")


def price_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = global_order.value_ranks(_lines(spark, sf_dir), ["price"], "l_orderkey", FINE_CUTTING)
    return ranks.select("price", "rows", "rank", "dense_rank", "total")


def top_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).withColumn("below", -F.col("l_quantity"))
    return global_order.top_with_ties(lines, ["below"], 10).drop("below")


# Snapshots and sketches


def _customers_later(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers, and the same after some have gone, come, changed or been repeated."""
    old = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    kept = old.filter(key % 11 != 0).withColumn(
        "c_acctbal", F.when(key % 13 == 0, F.col("c_acctbal") + 1).when(key % 31 != 0, F.col("c_acctbal"))
    )
    new = old.filter(key % 17 == 0).withColumn("c_custkey", key + 1_000_000_000)
    repeated = old.filter(key % 19 == 0)
    return old, kept.unionByName(new).unionByName(repeated)


def snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.difference(*_customers_later(spark, sf_dir), ["c_custkey"], 256)


def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = snapshots.changes(*_customers_later(spark, sf_dir), ["c_custkey"], 256)
    return found.select(
        "kind",
        "times",
        "c_custkey",
        F.col("before.c_acctbal").alias("balance_before"),
        F.col("after.c_acctbal").alias("balance_after"),
    )


def sales_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether sketches of cells, merged by region, keep their bounds against exact figures."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("region"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("amount"),
    )
    path = shared_folder(spark, "sketches")
    sketches.sketch_cells(orders, ["region", "month"]).write.parquet(path)
    merged = sketches.merged_cells(spark.read.parquet(path), ["region"]).select(
        "region",
        "records",
        sketches.distinct_customers().alias("estimate"),
        sketches.amount_quantile(0.5).alias("median"),
        F.size(sketches.frequent_customers(3)).alias("named"),
    )
    # One row per region; the exact figures read the orders again.
    kept = F.broadcast(saved_table(merged, "merged"))
    exact = orders.join(kept, "region").groupBy("region", "records", "estimate", "named").agg(
        F.count_distinct("customer").alias("customers"),
        F.avg((F.col("amount") <= F.col("median")).cast("double")).alias("share"),
    )
    off = F.abs(F.col("estimate") - F.col("customers")) / F.col("customers")
    return exact.select(
        "region",
        "records",
        "customers",
        (off <= sketches.DISTINCT_ERROR).alias("distinct_kept"),
        (F.abs(F.col("share") - 0.5) <= sketches.RANK_ERROR + 1 / F.col("records")).alias("median_kept"),
        F.col("named").cast("bigint").alias("named"),
    )


# Aggregates


def last_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_value(
        table(spark, sf_dir, "events"), ["user_id"], ["event_type", "event_id"], ["ts", "event_id"]
    )


def score_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "event_type", F.col("value").cast("string").alias("raw")
    )
    results = score_results(
        log, "user_id", "event_type", "raw", ["ts", "event_id"], ("click", "view", "purchase")
    )
    told = score_sentence(F.col("total"), F.col("mean"), F.col("result"))
    return results.withColumn("told", told)


def guess_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = event_counter(table(spark, sf_dir, "events"))
    odd = F.expr(
        "CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN NULL "
        "WHEN 3 THEN '0x00000000000000000005' ELSE raw END"
    )
    entered = counted.withColumn("raw", odd)
    return label_guesses(entered, "raw", "target").select("event_id", "guess", "answer")


def attempts_to_hit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = event_counter(table(spark, sf_dir, "events"))
    found = attempts_to_hit(counted, "user_id", "raw", "target", ["ts", "event_id"])
    return found.withColumn("told", attempts_sentence(F.col("attempts")))


def attempts_to_purchase_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts_to_purchase(spark, sf_dir, FINE_CUTTING)


def attempts_to_purchase(
    spark: SparkSession, sf_dir: str, cutting: Cutting = Cutting()
) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "ts",
        "event_id",
        F.col("value").isNotNull().alias("counts"),
        (F.col("event_type") == "purchase").alias("hit"),
    )
    return attempts_until(
        events, ["user_id"], ["ts", "event_id"], "counts", "hit", cutting=cutting
    )


def ordered_text_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_text_query(spark, sf_dir, 3, FINE_CUTTING)


def ordered_text_query(
    spark: SparkSession,
    sf_dir: str,
    lines_per_part: int = LINES_PER_PART,
    cutting: Cutting = Cutting(),
) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    keys = lines.select("l_partkey", "l_orderkey", "l_linenumber")
    named = lookup_join(lines, part, ["l_partkey"], hot_from=keys)
    return ordered_text(
        named,
        ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"],
        item_line(F.col("p_name"), F.col("l_quantity").cast("int")),
        lines_per_part=lines_per_part,
        cutting=cutting,
        cut_from=lines,
    )


# Pages


def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_facts(table(spark, sf_dir, "pages"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_links(table(spark, sf_dir, "pages"))


def inlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.inlinks(table(spark, sf_dir, "pages"))


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_items(table(spark, sf_dir, "pages"))


#: To make a file takes far more time than to write its bytes, so few are made in a task.
FILES_OF_FOLDER = 250


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of pages that stand in files of their own.

    Each task writes a folder of its own, which is put in place as a whole; folders are listed
    in parallel. Files are read once.
    """
    path = shared_folder(spark, "page-files")
    pages_ = spread(table(spark, sf_dir, "pages").select("page_id", "html"), FILES_OF_FOLDER)
    folders = pages_.select("html", F.spark_partition_id().alias("folder"))
    folders.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
    sized = read_pages(spark, path).withColumn("chars", (F.length("html") - 1).cast("bigint"))
    facts = pages.page_facts(sized, "page_id", "html", "chars").drop("page_id")
    return facts.select(*[name for name in facts.columns if name != "chars"], "chars")


def site_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_facts(customer_pages(table(spark, sf_dir, "customer")))


def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_links(customer_pages(table(spark, sf_dir, "customer")))


def site_inlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.inlinks(customer_pages(table(spark, sf_dir, "customer")))


def schedule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.schedule_lines(customer_pages(table(spark, sf_dir, "customer")))


def dated_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = pages.dated_marks(customer_pages(table(spark, sf_dir, "customer")))
    return marks.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def description_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.description_rows(part_pages(table(spark, sf_dir, "part")))


def description_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = pages.description_map(part_pages(table(spark, sf_dir, "part")))
    return described.select(
        "page_id",
        F.size("descriptions").cast("long").alias("terms"),
        F.col("descriptions")["brand"].alias("brand"),
        F.col("descriptions")["type"].alias("type"),
    )


def table_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.table_slots(part_pages(table(spark, sf_dir, "part")))


# Streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return change_events(spark, f"{sf_dir.rstrip('/')}/events.parquet*", schema)


def last_choice_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_latest_choice(
        _event_stream(spark, sf_dir),
        ["user_id"],
        ["event_type", "event_id"],
        ["ts", "event_id"],
        shared_folder(spark, "last-choice"),
    )


def late_choice_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same out of several files, one per batch, each with events of the whole time."""
    events = table(spark, sf_dir, "events")
    arrived = shared_folder(spark, "arrived")
    events.repartition(ARRIVALS, "event_id").write.parquet(arrived)
    return run_latest_choice(
        change_events(spark, arrived, events.schema, files_per_trigger=1),
        ["user_id"],
        ["event_type", "event_id"],
        ["ts", "event_id"],
        shared_folder(spark, "late-choice"),
    )


def folded_choice_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same out of a store that is folded every other batch."""
    return run_latest_choice(
        _arriving_events(spark, sf_dir),
        ["user_id"],
        ["event_type", "event_id"],
        ["ts", "event_id"],
        shared_folder(spark, "folded-choice"),
        fold_every=2,
    )


def active_choice_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a state that quiet keys leave."""
    found, _ = run_latest_choice_of_active_keys(
        _arriving_events(spark, sf_dir),
        ["user_id"],
        ["event_type", "event_id"],
        ["ts", "event_id"],
        shared_folder(spark, "active-choice"),
    )
    return found


#: Event-time windows: how late a row may be, and the sizes of the windows.
DELAY = "6 hours"
WIDE, SLIDE, GAP = "6 hours", "2 hours", "3 hours"


def _arriving_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in several batches, each with events of the whole time."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    arrived = shared_folder(spark, "arrived")
    for batch in range(ARRIVALS):
        part = events.filter(F.col("event_id") % ARRIVALS == batch)
        # A batch is one file; it is the test's unit of arrival.
        part.coalesce(1).write.mode("append").parquet(arrived)
    return change_events(spark, arrived, events.schema, files_per_trigger=1)


def _closed_windows(spark: SparkSession, sf_dir: str, window, keys: list[str]) -> DataFrame:
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    found, _ = run_windows(
        _arriving_events(spark, sf_dir),
        "ts",
        DELAY,
        window,
        keys,
        [F.count("*").alias("events"), total],
        shared_folder(spark, "windows"),
    )
    day = "yyyy-MM-dd HH:mm:ss"
    return found.withColumn("start", F.date_format("start", day)).withColumn("end", F.date_format("end", day))


def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed_windows(spark, sf_dir, F.window("ts", WIDE, SLIDE), ["event_type"])


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed_windows(spark, sf_dir, F.session_window("ts", GAP), ["user_id"])


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, late = run_gate(_arriving_events(spark, sf_dir), "ts", DELAY, shared_folder(spark, "gate"))
    return late.select("event_id", "user_id")


#: How old an observation may be, and how late either side.
HORIZON, LATENESS = "2 days", "1 day"


def observed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with the latest view of their user, out of two streams that come day by day."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    paths = {kind: shared_folder(spark, kind) for kind in ("click", "view")}
    for days in range(0, 31, 8):
        for kind, path in paths.items():
            now = F.dayofmonth("ts").between(days, days + 7) & (F.col("event_type") == kind)
            # A batch is one file; it is the test's unit of arrival.
            events.filter(now).coalesce(1).write.mode("append").parquet(path)
    clicks, views = (change_events(spark, paths[kind], events.schema, 1) for kind in ("click", "view"))
    found = run_as_of(
        clicks.select("event_id", "user_id", "ts"),
        views.select(F.col("event_id").alias("view_id"), "user_id", "ts", "value"),
        ["user_id"],
        "ts",
        "event_id",
        "view_id",
        ["view_id", "value"],
        HORIZON,
        LATENESS,
        shared_folder(spark, "observed"),
        fold_every=2,
    )
    return found.select("event_id", "user_id", "observed.view_id", "observed.value")


def enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per nation; made once, not for each batch.
    cities = saved_table(_cities(spark, sf_dir), "cities")

    def enrich(batch: DataFrame) -> DataFrame:
        value = F.when(F.col("event_type") != "error", F.col("value"))
        chosen = batch.select(
            "event_id",
            "user_id",
            (F.col("user_id") % CITY_COUNT).alias("city"),
            value.alias("observed"),
            F.when(value < MISSING_FROM, value).alias("temperature"),
        )
        placed = lookup_join(chosen, cities, ["city"]).select("*", "place.latitude", "place.longitude")
        told = with_status(placed, "place", "observed", "temperature", "latitude", "longitude")
        return told.select("event_id", "user_id", "label", "status", "latitude_text", "temperature")

    return run_enriched(_event_stream(spark, sf_dir), enrich, shared_folder(spark, "enriched"))


# Sales


def _by(*dimensions: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: sales.sales_by(sales_records(spark, sf_dir), *dimensions)


def _over_sales(
    summary: Callable[[DataFrame], DataFrame],
) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: summary(sales_records(spark, sf_dir))


def sales_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sales_records(spark, sf_dir).withColumn("month", F.substring("month", 6, 2))
    return sales.sales_pivot(records, CALENDAR_MONTHS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "accepted_rows": accepted_rows,
    "rejected_rows": rejected_rows,
    "error_texts": error_texts,
    "written_accepted": written_accepted,
    "written_rejects": written_rejects,
    "written_split": written_split,
    "literal_points": literal_points,
    "page_files": page_files,
    "score_reasons": score_reasons,
    "secret_numbers": secret_numbers,
    "form_submissions": form_submissions,
    "form_violations": form_violations,
    "payload_fields": payload_fields,
    "payload_answers": payload_answers,
    "query_params": query_params,
    "label_lookup": label_lookup_query,
    "city_labels": city_labels,
    "first_match": first_match_query,
    "current_value": current_value_query,
    "observed_value": observed_value,
    "enriched_status": enriched_status,
    "last_choice": last_choice,
    "score_result": score_result,
    "guess_answers": guess_answers,
    "attempts_to_hit": attempts_to_hit_query,
    "attempts_to_purchase": attempts_to_purchase,
    "ordered_text": ordered_text_query,
    "page_facts": page_facts,
    "page_links": page_links,
    "inlinks": inlinks,
    "page_items": page_items,
    "site_facts": site_facts,
    "site_links": site_links,
    "site_inlinks": site_inlinks,
    "schedule_lines": schedule_lines,
    "dated_marks": dated_marks,
    "description_rows": description_rows,
    "description_map": description_map,
    "table_slots": table_slots,
    "last_choice_stream": last_choice_stream,
    "late_choice_stream": late_choice_stream,
    "enriched_stream": enriched_stream,
    "folded_choice_stream": folded_choice_stream,
    "active_choice_stream": active_choice_stream,
    "sliding_windows": sliding_windows,
    "session_windows": session_windows,
    "late_events": late_events,
    "observed_stream": observed_stream,
    "skewed_pairs": skewed_pairs,
    "skewed_full": skewed_full,
    "skewed_semi_anti": skewed_semi_anti,
    "interval_overlaps": interval_overlaps,
    "line_numbers": line_numbers,
    "line_tiles": line_tiles,
    "quantity_ranks": quantity_ranks,
    "price_ranks": price_ranks,
    "top_quantities": top_quantities,
    "snapshot_difference": snapshot_difference,
    "snapshot_changes": snapshot_changes,
    "sales_sketches": sales_sketches,
    "sales_by_region": _by("region"),
    "sales_by_category": _by("category"),
    "sales_by_month": _by("month"),
    "json_array_rows": json_array_rows,
    "assigned_array_rows": assigned_array_rows,
    "array_line_rows": array_line_rows,
    "split_array_rows": split_array_rows,
    "label_lookup_salted": label_lookup_salted,
    "observed_value_cut": observed_value_cut,
    "attempts_to_purchase_cut": attempts_to_purchase_cut,
    "ordered_text_parts": ordered_text_parts,
    "sales_cube": _over_sales(sales.sales_cube),
    "sales_rollup": _over_sales(sales.sales_rollup),
    "sales_pivot": sales_pivot,
    "top_category": _over_sales(sales.top_category),
    "month_change": _over_sales(sales.month_change),
    "region_share": _over_sales(sales.region_share),
}
