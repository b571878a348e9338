"""Landed inputs: pages and fetch attempts, geocoder answers, boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
CEP_POINTS = T.StructType(
    [
        T.StructField("cep", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)
# Fields of a geocoder answer that are read.
GEOCODER_ANSWER = "status string, results array<struct<geometry: struct<location: struct<lat: double, lng: double>>>>"


class BoundaryMissing(Exception):
    """No boundary edition falls in the years asked for."""


def latest_boundary(boundary: DataFrame, this_year: int, first_year: int = 2000) -> DataFrame:
    """Vertices of the newest edition not later than `this_year`."""
    eligible = boundary.filter(F.col("year").between(first_year, this_year))
    newest = eligible.agg(F.max("year").alias("m")).head()["m"]
    if newest is None:
        raise BoundaryMissing(f"no boundary between {first_year} and {this_year}")
    return boundary.filter(F.col("year") == newest)


def boundary_of_year(boundary: DataFrame, year: int) -> DataFrame:
    return boundary.filter(F.col("year") == year)


def geocoder_points(answers: DataFrame, body: str = "body") -> DataFrame:
    """First result of every answer with status OK and a result; other answers drop out."""
    parsed = answers.withColumn("__answer", F.from_json(F.col(body), GEOCODER_ANSWER))
    good = (F.col("__answer.status") == "OK") & (F.size("__answer.results") > 0)
    spot: Column = F.col("__answer.results")[0]["geometry"]["location"]
    return parsed.filter(good).select(
        *[F.col(c) for c in answers.columns if c != body],
        spot["lat"].alias("latitude"),
        spot["lng"].alias("longitude"),
    )
