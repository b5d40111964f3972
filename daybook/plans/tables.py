"""The test tables, and inputs that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.computed import spread
from daybook.operators.lookups import label_lookup, lookup_join


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files only once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def sales_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sales records: nation, market segment, price and month."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    buyers = label_lookup(
        customer, "c_nationkey", nation, "n_nationkey", "n_name", "region"
    ).select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("category"), "region")
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.col("o_totalprice").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    return lookup_join(
        orders,
        buyers,
        ["o_custkey"],
        size_from=customer,
        hot_from=orders.select("o_custkey", "o_orderkey"),
    ).select("region", "category", "amount", "month")


def event_counter(events: DataFrame) -> DataFrame:
    """Events with the number of their properties, and a target number per user."""
    return events.select(
        "event_id",
        "user_id",
        "ts",
        F.from_json("props", "k bigint")["k"].cast("string").alias("raw"),
        (F.col("user_id") % 50 + 1).alias("target"),
    )


def submission_urls(customer: DataFrame) -> DataFrame:
    """A sign-up address per customer, good and bad ones in turn."""
    key = F.col("c_custkey")
    user_id = F.expr("substring(c_name, 1, cast(2 + c_custkey % 17 AS int))")
    return spread(customer.select("c_custkey", "c_name")).select(
        "c_custkey",
        F.concat(
            F.lit("signUpResult.html?userId="),
            F.url_encode(user_id),
            F.lit("&userPw="),
            F.repeat(F.lit("x"), (key % 11).cast("int")),
            F.when(key % 3 != 0, "&emailDomain=naver.com").otherwise("&emailDomain=post.example"),
            F.when(key % 5 != 0, F.concat(F.lit("&userName=a+"), key.cast("string"))).otherwise(""),
            F.when(key % 7 == 0, "&userBirth=2001-02-30")
            .when(key % 7 == 1, "&userBirth=2001-02-28")
            .when(key % 7 == 2, "&userBirth=")
            .otherwise(""),
            F.when(key % 2 == 0, "&gender=female").otherwise(""),
            F.when(key % 4 == 0, "&interest=uiux&interest=backend")
            .when(key % 4 == 1, "&interest=chess")
            .otherwise(""),
            F.when(key % 6 == 0, "&joinPath=").when(key % 6 == 1, "&joinPath=sns").otherwise(""),
            F.lit("&intro="),
            F.repeat(F.lit("%ED%97%88"), (key % 203).cast("int")),
        ).alias("url"),
    )


def part_pages(part: DataFrame) -> DataFrame:
    """A page per part with a description list and a table with spans."""
    high = (F.col("p_size") % 3 + 1).cast("string")
    wide = (F.col("p_size") % 4 + 1).cast("string")
    return part.select(
        F.col("p_partkey").alias("page_id"),
        F.concat(
            F.lit("<html><body><!-- <dl><dt>no</dt><dd>no</dd></dl> --><dl class='d'><dt>brand</dt><dd>"),
            "p_brand",
            F.lit("</dd><dt><b>type</b></dt><dd>"),
            "p_type",
            F.lit("</dd><dd>"),
            F.col("p_size").cast("string"),
            F.lit("</dd></dl><table><tr><td rowspan="),
            high,
            F.lit(">"),
            "p_brand",
            F.lit("</td><th colspan='"),
            wide,
            F.lit("'>"),
            "p_type",
            F.lit("</th></tr><tr><td>second</td></tr><tr class=\"x\"><td>third<br>line</td></tr></table></body></html>"),
        ).alias("html"),
    )


def customer_pages(customer: DataFrame) -> DataFrame:
    """A page per customer with schedule lines in two sections, dates and links."""
    hour = F.lpad((F.col("c_custkey") % 24).cast("string"), 2, "0")
    day = F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0")
    year = (F.col("c_custkey") % 30 + 1995).cast("string")
    key = F.col("c_custkey").cast("string")
    return customer.select(
        F.col("c_custkey").alias("page_id"),
        F.concat(
            F.lit("http://site.example/n"),
            F.col("c_nationkey").cast("string"),
            F.lit("/p"),
            key,
            F.lit(".html?x=1#top"),
        ).alias("url"),
        F.concat(
            F.lit("<html lang=ko><head><meta name=\"description\" content='about "),
            key,
            F.lit("'><title> Page "),
            key,
            F.lit("</title></head><p><b>07:30</b> - early</p><h2>One</h2><p><b>"),
            hour,
            F.lit(":15</b> - <mark>"),
            F.col("c_mktsegment"),
            F.lit("</mark> work</p><p>no time</p><h2 class='k'><ins>Two</ins></h2><p><b>23:05</b> - "),
            F.col("c_name"),
            F.lit("</p><time datetime=\""),
            year,
            F.lit("-02-"),
            day,
            F.lit("\">then</time><p>photo ("),
            year,
            F.lit("년)</p><a class='z' href='home.html#a'>h</a><a href=\"/n"),
            F.col("c_nationkey").cast("string"),
            F.lit("\">n</a><a href=https://else.example/>e</a><A HREF='mailto:a@b.example'>m</A></html>"),
        ).alias("html"),
    )
