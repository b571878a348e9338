"""Typed, de-duplicated, valid ads from bronze text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import parse_number, repair_thousands, zero_to_null
from ..schemas import NUMERIC_COLUMNS, PRICE, col
from .distinct import distinct_except

MAX_PRICE = 100_000_000.0


def parsed_numbers(ads: DataFrame) -> DataFrame:
    """Parse the five numeric columns, once per row.

    They come out of a one-row generator. Out of a projection, a filter on the price would move
    below it and take a copy of the parsing along for each mention of the price.
    """
    numbers = F.struct(*[parse_number(col(c)).alias(c) for c in NUMERIC_COLUMNS])
    rest = [col(c) for c in ads.columns if c not in NUMERIC_COLUMNS]
    return ads.select(*rest, F.inline(F.array(numbers))).select(*[col(c) for c in ads.columns])


def repaired_numbers(parsed: DataFrame) -> DataFrame:
    """Prices in full units, zero counts blanked out."""
    return parsed.withColumns(
        {
            PRICE: repair_thousands(col(PRICE)),
            **{c: zero_to_null(F.col(c)) for c in ("n_quartos", "n_banheiros", "n_vagas_garagem")},
        }
    )


def with_numbers(ads: DataFrame) -> DataFrame:
    return repaired_numbers(parsed_numbers(ads))


def valid_price(ads: DataFrame) -> DataFrame:
    """Price given, not zero, below the ceiling."""
    return ads.filter((col(PRICE) != 0) & (col(PRICE) < MAX_PRICE))


def with_coordinates(ads: DataFrame) -> DataFrame:
    return ads.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def missing_coordinates(ads: DataFrame) -> DataFrame:
    return ads.filter(F.col("latitude").isNull() | F.col("longitude").isNull())


def valid_urls(ads: DataFrame) -> DataFrame:
    return ads.filter(F.col("url").isNotNull() & (F.col("url") != ""))


def clean_ads(ads: DataFrame, need_coordinates: bool = False) -> DataFrame:
    """Cleaned ads.

    Validity tests read only columns that duplicates share, so they run before the
    de-duplication. The price test runs before the repair: the repair turns no valid price
    into an invalid one, nor the reverse, since what it multiplies stays far below the ceiling.
    """
    typed = valid_price(parsed_numbers(ads))
    if need_coordinates:
        typed = with_coordinates(typed)
    return distinct_except(repaired_numbers(typed), "url")
