"""Numbers found in listing text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def parse_number(text: Column, grouping: str = ",", decimal: str = ".") -> Column:
    """Number at the first digit, minus sign or decimal mark of `text`, as double.

    Text before and after is dropped, and so are grouping marks. NULL when no number starts
    there: "70 m2" reads as 70, but "Av. 5" as NULL, since its first mark is the full stop.
    With the default marks, "R$ 350.000" reads as 350 and "1.250.000" as 1.25;
    `repair_thousands` undoes the first of these.
    """
    g, d = re.escape(grouping), re.escape(decimal)
    digits = f"[0-9][0-9{g}]*"
    pattern = f"^[^0-9{d}-]*(-?{g}*(?:{digits}(?:{d}[0-9{g}]*)?|{d}{g}*{digits})(?:[eE][+-]?[0-9]+)?)"
    number = F.replace(F.regexp_extract(text, pattern, 1), F.lit(grouping), F.lit(""))
    if decimal != ".":
        number = F.replace(number, F.lit(decimal), F.lit("."))
    return number.try_cast("double")


def repair_thousands(price: Column, below: float = 10000.0, factor: float = 1000.0) -> Column:
    """Prices quoted in thousands, brought to full units."""
    return price * F.when(price < below, factor).otherwise(1.0)


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))


def plain_number(value: Column) -> Column:
    """Double as text without a trailing ".0"."""
    whole = value.try_cast("bigint")
    return F.when(value == whole, whole.cast("string")).otherwise(value.cast("string"))


def room_label(rooms: Column) -> Column:
    """1 -> "1_quarto", 3 -> "3_quartos", 2.5 -> "2.5_quartos"; NULL stays NULL."""
    noun = F.when(rooms == 1, "quarto").otherwise("quartos")
    return F.when(rooms.isNotNull(), F.concat_ws("_", plain_number(rooms), noun))


def last_count(text: Column) -> Column:
    """Last dotted whole number in a result-count text, such as "1 - 50 de 12.345"."""
    found = F.regexp_extract_all(text, F.lit(r"([0-9]{1,3}(?:\.[0-9]{3})*)"), F.lit(1))
    return F.replace(F.try_element_at(found, F.lit(-1)), F.lit("."), F.lit("")).try_cast("int")


def page_count(text: Column, per_page: int = 50) -> Column:
    return F.ceil(last_count(text) / F.lit(per_page)).cast("int")
