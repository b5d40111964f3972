"""Keys and values out of the query strings of URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAMS_TYPE = "array<struct<key:string,value:string>>"


def query_text(url: Column) -> Column:
    """What stands between ``?`` and ``#``; empty where there is nothing."""
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def params(url: Column) -> Column:
    """The decoded pairs in their order. Wrong escapes give NULL, a missing ``=`` an empty value."""
    pairs = F.filter(F.split(query_text(url), "&"), lambda pair: pair != "")
    return F.transform(
        pairs,
        lambda pair: F.struct(
            F.try_url_decode(F.regexp_extract(pair, "^([^=]*)", 1)).alias("key"),
            F.try_url_decode(F.regexp_extract(pair, "^[^=]*=(.*)$", 1)).alias("value"),
        ),
    )


def first_param(pairs: Column, key: str) -> Column:
    """The first value of a key, NULL where it is not sent."""
    return F.get(F.filter(pairs, lambda pair: pair["key"] == key), 0)["value"]


def all_params(pairs: Column, key: str) -> Column:
    """All values of a repeated key, in order; empty where it is not sent."""
    return F.transform(
        F.filter(pairs, lambda pair: pair["key"] == key), lambda pair: pair["value"]
    )


def param_rows(pages: DataFrame, page_id: str, url: str) -> DataFrame:
    """One row per pair of each URL's query string."""
    return pages.select(
        page_id, F.posexplode(params(F.col(url))).alias("pos", "param")
    ).select(page_id, F.col("pos").cast("long").alias("pos"), "param.key", "param.value")
