"""Price indicators per group: extremes, mean, price per area, mean price by room count.

Sums do not depend on the order of rows (`functions/sums.py`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import room_label
from ..functions.sums import add_up, digits, exact_mean, exact_sum, total
from ..schemas import PRICE, col
from ..session import materialise
from .joins import left_join_nullsafe

MIN_AREA = 10.0


def _has_area() -> Column:
    return col(PRICE).isNotNull() & F.col("area_m2").isNotNull() & (F.col("area_m2") > MIN_AREA)


def price_stats(ads: DataFrame, key: str) -> DataFrame:
    return ads.groupBy(key).agg(
        F.max(col(PRICE)).alias("preco_max"),
        F.min(col(PRICE)).alias("preco_min"),
        exact_mean(col(PRICE)).alias("preco_med"),
    )


def price_per_area(ads: DataFrame, key: str) -> DataFrame:
    """Sum of prices over sum of areas, half-to-even at one decimal, over rows with a usable area."""
    sums = ads.filter(_has_area()).groupBy(key).agg(exact_sum(col(PRICE)).alias("p"), exact_sum(F.col("area_m2")).alias("a"))
    return sums.select(key, F.bround(F.try_divide("p", "a"), 1).alias("preco_medio_area"))


def rooms_long(ads: DataFrame, key: str) -> DataFrame:
    """Mean price by room label and key; ads without a room count drop out."""
    labelled = ads.filter(F.col("n_quartos").isNotNull()).withColumn("n_quartos", room_label(F.col("n_quartos")))
    return labelled.groupBy("n_quartos", key).agg(exact_mean(col(PRICE)).alias("media_quarto"))


def room_labels(ads: DataFrame) -> DataFrame:
    return ads.filter(F.col("n_quartos").isNotNull()).select(room_label(F.col("n_quartos")).alias("n_quartos")).distinct()


def rooms_pivot(ads: DataFrame, key: str, labels: list[str] | None = None) -> DataFrame:
    """One row per key, one column per room label in label order; NULL where a key has none.

    Without `labels` the label set is read from the data first.
    """
    means = rooms_long(ads, key)
    pivot = means.groupBy(key).pivot("n_quartos", labels) if labels else means.groupBy(key).pivot("n_quartos")
    return pivot.agg(F.first("media_quarto"))


def indicators_by_join(ads: DataFrame, key: str, labels: list[str] | None = None) -> DataFrame:
    """The indicators put together from their parts by NULL-matching left joins."""
    out = left_join_nullsafe(price_stats(ads, key), price_per_area(ads, key), key)
    return left_join_nullsafe(out, rooms_pivot(ads, key, labels), key)


def indicators(ads: DataFrame, key: str, labels: list[str] | None = None) -> DataFrame:
    """All indicators per `key`, NULL group included, in one pass over the ads.

    The ads collapse to one row per (key, room count) with map-side combining; the rest
    works on that small table, so neither a frequent key nor a wide pivot moves more rows.
    """
    with_area = _has_area()
    per_rooms = ads.groupBy(key, "n_quartos").agg(
        F.max(col(PRICE)).alias("hi"),
        F.min(col(PRICE)).alias("lo"),
        add_up(digits(col(PRICE))).alias("total"),
        F.count(col(PRICE)).alias("n"),
        add_up(digits(F.when(with_area, col(PRICE)))).alias("area_total"),
        add_up(digits(F.when(with_area, F.col("area_m2")))).alias("area"),
    ).withColumn("label", room_label(F.col("n_quartos")))
    if labels is None:
        # Read twice: for the labels, which become column names, and for the final aggregate.
        per_rooms = materialise(per_rooms, "rooms")
        most = int(ads.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        distinct = per_rooms.select("label").filter(F.col("label").isNotNull()).distinct()
        found = distinct.orderBy("label").limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"more than {most} room labels; see spark.sql.pivotMaxValues, or use rooms_long")
        labels = [row["label"] for row in found]
    by_label = [
        F.try_divide(
            total(add_up(F.when(F.col("label") == name, F.col("total")))), F.sum(F.when(F.col("label") == name, F.col("n")))
        ).alias(name)
        for name in labels
    ]
    return per_rooms.groupBy(key).agg(
        F.max("hi").alias("preco_max"),
        F.min("lo").alias("preco_min"),
        F.try_divide(total(add_up(F.col("total"))), F.sum("n")).alias("preco_med"),
        F.bround(F.try_divide(total(add_up(F.col("area_total"))), total(add_up(F.col("area")))), 1).alias("preco_medio_area"),
        *by_label,
    )
