"""Values out of nested JSON answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOCODE_SCHEMA = "results array<struct<latitude:double,longitude:double>>"
WEATHER_SCHEMA = "current struct<temperature_2m:double,relative_humidity_2m:double>"


def payload(text: Column, schema: str) -> Column:
    """JSON text as a struct that has only the fields asked for; broken text gives NULLs."""
    return F.from_json(text, schema)


def with_coordinates(rows: DataFrame, text: str) -> DataFrame:
    """Add latitude and longitude of the first result; NULL where there is none."""
    first = F.get(F.col("_geo.results"), 0)
    return (
        rows.withColumn("_geo", payload(F.col(text), GEOCODE_SCHEMA))
        .withColumn("latitude", first["latitude"])
        .withColumn("longitude", first["longitude"])
        .drop("_geo")
    )


def with_weather(rows: DataFrame, text: str) -> DataFrame:
    """Add temperature and humidity of a weather answer."""
    return (
        rows.withColumn("_weather", payload(F.col(text), WEATHER_SCHEMA))
        .withColumn("temperature", F.col("_weather.current.temperature_2m"))
        .withColumn("humidity", F.col("_weather.current.relative_humidity_2m"))
        .drop("_weather")
    )
