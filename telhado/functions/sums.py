"""Sums of doubles that come out alike in any order of rows.

A double is taken apart into four whole numbers of 26 bits each, down to 2^-52. Those are added up
as longs, which is exact, and put together once at the end. So no partitioning and no retried
task changes a bit, and a mean that lies on a tie is rounded the same way in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WEIGHTS = (2.0**26, 1.0, 2.0**-26, 2.0**-52)
# Whole numbers below it are exact as doubles. A sum of 2^36 rows still fits its longs.
LIMIT = 2.0**53


def digits(x: Column) -> Column:
    """Struct (d0 to d3, rest) of a double; NULL fields for a NULL.

    What has no digits, beyond the limit or not finite, is the `rest`. Of values below one, what
    lies beyond 2^-52 is cut off.
    """
    x = x.cast("double")
    within = F.abs(x) < LIMIT
    # Digits of the absolute value: taking a floor of a negative one would round it.
    left, sign, fields = F.when(within, F.abs(x)), F.signum(x), []
    for i, weight in enumerate(WEIGHTS):
        digit = F.floor(left / weight)
        left = left - digit * weight
        fields.append((digit * sign).cast("long").alias(f"d{i}"))
    return F.struct(*fields, F.when(~within, x).alias("rest"))


def add_up(parts: Column) -> Column:
    """Aggregate of `digits`, or of sums of them: the same struct again."""
    names = [*(f"d{i}" for i in range(len(WEIGHTS))), "rest"]
    return F.struct(*[F.sum(parts[name]).alias(name) for name in names])


def total(parts: Column) -> Column:
    """The double that a struct of sums stands for; NULL where nothing was added up."""
    whole = sum((parts[f"d{i}"] * weight for i, weight in enumerate(WEIGHTS[1:], 1)), parts["d0"] * WEIGHTS[0])
    return F.when(parts["rest"].isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + parts["rest"])


def exact_sum(x: Column) -> Column:
    """Aggregate: the sum of a column, NULLs left out; NULL where there is no value."""
    return total(add_up(digits(x)))


def exact_mean(x: Column) -> Column:
    """Aggregate: the mean of a column, NULLs left out; NULL where there is no value."""
    return F.try_divide(exact_sum(x), F.count(x))
