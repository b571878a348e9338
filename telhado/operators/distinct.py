"""Deterministic forms of "keep one row per key"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import col


def distinct_keys(df: DataFrame, key: str = "url") -> DataFrame:
    """Distinct non-empty keys."""
    return df.select(key).filter(col(key).isNotNull() & (col(key) != "")).distinct()


def first_per_key(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """First row per `key` in the given order; ties go to the least remaining values.

    An aggregate of one struct per key: each map task passes on one row per key, so
    a key that holds a third of the rows costs no more than another.
    """
    rank = [col(o) if isinstance(o, str) else o for o in order] or [F.lit(0)]
    rest = [c for c in df.columns if c != key]
    ranked = df.select(
        col(key),
        F.struct(
            F.struct(*[c.alias(f"o{i}") for i, c in enumerate(rank)]).alias("rank"),
            F.struct(*[col(c) for c in rest]).alias("row"),
        ).alias("entry"),
    )
    best = ranked.groupBy(col(key)).agg(F.min("entry").alias("entry"))
    return best.select(col(key), *[F.col("entry.row").getField(c).alias(c) for c in rest]).select(
        *[col(c) for c in df.columns]
    )


def distinct_except(df: DataFrame, key: str = "url") -> DataFrame:
    """One row per combination of all columns but `key`, keeping the least `key`.

    Copies collapse in the map tasks, so a row repeated very often does not travel. The hash in
    front of the grouping columns makes their sort compare one number instead of long texts.
    """
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(F.xxhash64(*[col(c) for c in rest]).alias("__hash"), *[col(c) for c in rest])
    return grouped.agg(F.min(col(key)).alias(key)).select(*[col(c) for c in df.columns])
