"""Join of values to the given intervals that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .joins import SALT, SIZE_MARGIN, broadcast_limit, heavy_hitters, hot_salted, planned_bytes, refuse_columns

# Intervals narrower than 2 to this power are indexed as if they were as wide.
LEAST_LEVEL = -20
CELL = ["__level", "__cell"]


def _cell(value: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), F.col("__level"))).cast("bigint")


def indexed(intervals: DataFrame, low: str, high: str) -> DataFrame:
    """Each interval with the cells it touches: cells as wide as the next power of two above its width, so two at most.

    Both ends belong to an interval; one whose ends are NULL, not finite or the wrong way round holds nothing and is left out.
    """
    a, b = F.col(low).cast("double"), F.col(high).cast("double")
    sound = (a <= b) & (F.abs(a) < float("inf")) & (F.abs(b) < float("inf")) & ~F.isnan(a) & ~F.isnan(b)
    level = F.greatest(F.lit(LEAST_LEVEL), F.when(b > a, F.ceil(F.log2(b - a))).otherwise(LEAST_LEVEL)).cast("int")
    placed = intervals.where(sound).withColumn("__level", level)
    return placed.withColumn("__cell", F.explode(F.sequence(_cell(a), _cell(b))))


def interval_join(rows: DataFrame, intervals: DataFrame, value: str, low: str = "low", high: str = "high") -> DataFrame:
    """A row for each row of `rows` and interval with `low` <= `value` <= `high`, with all columns of both.

    Intervals may be irregular, overlap and leave gaps. Each is listed under the one or two cells of its own level,
    a value looks into its cell at each level there is (a few, and at most about a thousand), and the
    ends decide. A level's cell holds no more intervals than overlap there. Values that are NULL or not
    finite are in none; cells that hold very many values are split.
    """
    refuse_columns(rows, {*CELL, SALT, *intervals.columns})
    refuse_columns(intervals, {*CELL, SALT})
    index = indexed(intervals, low, high)
    levels = sorted(r[0] for r in index.select("__level").distinct().collect())
    if not levels:
        levels = [LEAST_LEVEL]
    v = F.col(value).cast("double")
    looked = rows.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))).withColumn("__level", F.explode(F.array(*map(F.lit, levels))))
    looked = looked.withColumn("__cell", _cell(v))
    if planned_bytes(index) * SIZE_MARGIN <= broadcast_limit(index):
        joined = looked.join(F.broadcast(index), CELL)
    else:
        spread, copies = hot_salted(looked, index, CELL, [value], heavy_hitters(looked, CELL))
        joined = spread.join(copies.hint("merge"), [*CELL, SALT]).drop(SALT)
    return joined.where(v.between(F.col(low), F.col(high))).drop(*CELL)


def count_by_interval(rows: DataFrame, intervals: DataFrame, value: str, low: str = "low", high: str = "high") -> DataFrame:
    """The intervals, each with `n_rows`: how many rows have their value in it. Equal values are counted before they are joined.

    Repeated intervals each keep their row.
    """
    ends = intervals.select(low, high).distinct()
    values = rows.groupBy(F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    counted = interval_join(values, ends, "__value", low, high).groupBy(low, high).agg(F.sum("__n").alias("n_rows"))
    return intervals.join(counted, [low, high], "left").fillna(0, ["n_rows"]).select(*intervals.columns, "n_rows")
