"""Collection planning: price bands, request addresses, page fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbers import page_count
from ..functions.text import search_url

# Fixed values: (from, to, step) of the price bands, and the open last band.
BAND_PHASES = [(0, 2_000_000, 50_000), (2_000_000, 10_000_000, 100_000)]
LAST_BAND = (10_000_000, 10_000_000_000)


def price_bands(spark: SparkSession) -> DataFrame:
    """All price bands, both ends included: (low, high)."""
    parts = [
        spark.range(start, stop, step, numPartitions=1).select(
            F.col("id").alias("low"), (F.col("id") + step - 1).alias("high")
        )
        for start, stop, step in BAND_PHASES
    ]
    low, high = LAST_BAND
    parts.append(spark.range(1).select(F.lit(low).alias("low"), F.lit(high).alias("high")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("low").cast("bigint"), F.col("high").cast("bigint"))


def _band_low(price: Column) -> Column:
    low = F.lit(LAST_BAND[0]).cast("bigint")
    for start, stop, step in reversed(BAND_PHASES):
        floor = (F.floor((price - start) / F.lit(step)) * step + start).cast("bigint")
        low = F.when(price < stop, floor).otherwise(low)
    return low


def _band_high(low: Column) -> Column:
    high = F.lit(LAST_BAND[1]).cast("bigint")
    for _, stop, step in reversed(BAND_PHASES):
        high = F.when(low < stop, low + step - 1).otherwise(high)
    return high


def count_by_band(ads: DataFrame, price: str) -> DataFrame:
    """Ads per band that holds any: (low, high, n_ads).

    Bands are regular, so arithmetic finds them and nothing is joined. A fractional price
    between two bands is in neither, so the ends are tested while counting.
    """
    low = _band_low(F.col(price))
    inside = (F.col(price) >= F.col("low")) & (F.col(price) <= _band_high(F.col("low")))
    counted = (
        ads.select(price, low.alias("low"))
        .groupBy("low")
        .agg(F.count_if(inside & (F.col("low") >= BAND_PHASES[0][0])).alias("n_ads"))
    )
    return counted.filter(F.col("n_ads") > 0).select("low", _band_high(F.col("low")).alias("high"), "n_ads")


def with_request_url(bands: DataFrame, base: str, page: Column | None = None) -> DataFrame:
    """Add `request_url`; page 1 unless told otherwise."""
    return bands.withColumn(
        "request_url", search_url(base, F.col("low"), F.col("high"), F.lit(1) if page is None else page)
    )


def with_page_count(answers: DataFrame, text: str = "result_text") -> DataFrame:
    return answers.withColumn("n_pages", page_count(F.col(text)))


def with_results(answers: DataFrame) -> DataFrame:
    """Requests worth paging through: fetched, counted, and not empty."""
    return answers.filter((F.col("status") == 200) & F.col("n_pages").isNotNull() & (F.col("n_pages") > 0))


def page_requests(answers: DataFrame) -> DataFrame:
    """One row per result page, numbered from 1. No row where there is no page."""
    return with_results(answers).withColumn("page", F.explode(F.sequence(F.lit(1), F.col("n_pages"))))
