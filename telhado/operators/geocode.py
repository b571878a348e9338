"""Coordinates by postal code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import standard_cep
from ..session import materialise
from .boundary import points_in_boundary
from .joins import lookup_join, union_all

# Distinct values that one running sum may order.
RANGE_ROWS = 1_000_000
# Size of a quantile sketch: up to so many values it is exact. Beyond, ranks are off by less than SLACK
# in all but a few cases of a million; the counts that follow notice those.
SKETCH = 400
SLACK = 0.03
GRID = 128


def cep_medians(points: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Exact median latitude and longitude of each postal code's points; NULLs and non-finite numbers left out."""
    return exact_medians(points, "cep", ["latitude", "longitude"], range_rows)


def exact_medians(df: DataFrame, key: str, columns: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Exact median of each column's finite values per key, whatever the size of a group.

    One pass sketches all columns of all groups, with map-side combining. A sketch that holds
    all its values gives the median itself; a larger group's tells between which two values
    the median lies, and a second pass counts the values there. Brackets that hold more than `range_rows`
    rows are narrowed by another sketch of what is inside first, and one that missed is moved on.
    """
    values = [
        F.when(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c).cast("double")) for c in columns
    ]
    rows = df.select(F.struct(F.col(key)).alias("__k"), F.array(*values).alias("__v"))
    whole = [
        F.struct(
            F.lit(i).alias("c"), F.count(v).alias("inside"), F.lit(0).cast("long").alias("below"), F.min(v).alias("lo"),
            F.max(v).alias("hi"), F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("sketch"),
        )
        for i, v in enumerate([F.col("__v")[i] for i in range(len(columns))])
    ]
    first = rows.groupBy("__k").agg(F.array(*whole).alias("s")).select("__k", F.inline("s"))
    n = F.col("inside")
    first = first.withColumns({"m1": F.floor((n + 1) / 2), "m2": F.floor(n / 2) + 1, "least": F.col("lo"), "most": F.col("hi")})
    state = materialise(_narrowed(first), "medians")
    known = [state.where("settled")]
    while not (pending := state.where("NOT settled")).isEmpty():
        ready = (F.col("size") <= range_rows) | (F.col("lo") == F.col("hi"))
        brackets = pending.select("__k", "c", "m1", "m2", "lo", "hi", "least", "most", "size")
        steps = []
        if not (few := brackets.where(ready)).isEmpty():
            steps.append(_counted(_inside(rows, few)))
        if not (many := brackets.where(~ready)).isEmpty():
            steps.append(_narrowed(_sketched(_inside(rows, many))))
        state = materialise(union_all(steps), "medians")
        known.append(state.where("settled"))
    medians = union_all([k.select("__k", "c", "median") for k in known]).groupBy("__k").agg(
        *[F.max(F.when(F.col("c") == i, F.col("median"))).alias(c) for i, c in enumerate(columns)]
    )
    return medians.select(F.col(f"__k.{key}").alias(key), *columns)


STATE = ["__k", "c", "m1", "m2", "lo", "hi", "least", "most", "size", "settled", "median"]


def _mean(a: Column, b: Column) -> Column:
    return F.when(a == b, a).otherwise((a + b) / 2)


def _moved(covered: Column) -> dict[str, Column]:
    """The bracket that must hold the ranks where the last one did not: on towards the least or the most."""
    lo = F.when(F.col("m1") <= F.col("below"), F.col("least")).otherwise(F.col("lo"))
    hi = F.when(F.col("m2") > F.col("below") + F.col("inside"), F.col("most")).otherwise(F.col("hi"))
    return {"lo": F.when(covered, F.col("lo")).otherwise(lo), "hi": F.when(covered, F.col("hi")).otherwise(hi)}


def _narrowed(sketched: DataFrame) -> DataFrame:
    """State after a sketch of what lies inside [lo, hi]: the median, or a narrower bracket around its ranks."""
    n = F.col("inside")
    # While all values of a group are in the sketch, these two ranks are its middle ones.
    exact = (n <= SKETCH) & (F.col("below") == 0) & (F.col("lo") == F.col("least")) & (F.col("hi") == F.col("most"))
    exact = (n == 0) | F.coalesce(exact, F.lit(False))
    ranks = [0.5, 0.5 + 1e-6, *(i / GRID for i in range(GRID + 1))]
    read = sketched.withColumn("q", F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, ranks)))))
    covered = (n == 0) | ((F.col("below") < F.col("m1")) & (F.col("m2") <= F.col("below") + n))
    read = read.withColumn("covered", covered)

    def at(m: str, slack: float, rounding) -> Column:
        step = rounding(((F.col(m) - F.col("below") - 0.5) / n + slack) * GRID).cast("int")
        return F.get("q", F.greatest(F.lit(0), F.least(F.lit(GRID), step)) + 2)

    narrow = F.col("covered") & (n > 0)
    lo, hi = at("m1", -SLACK, F.floor), at("m2", SLACK, F.ceil)
    same = narrow & (lo == F.col("lo")) & (hi == F.col("hi"))
    moved = _moved(F.col("covered"))
    out = read.withColumns(
        {
            "settled": exact,
            "median": F.when(exact, _mean(F.get("q", F.lit(0)), F.get("q", F.lit(1)))),
            # A bracket that a sketch cannot narrow holds few different values, however many rows.
            "size": F.when(same, 0).when(narrow, F.ceil(n * (2 * SLACK + 2 / GRID))).otherwise(F.lit(2**62)).cast("long"),
            "least": F.when(narrow, F.col("lo")).otherwise(F.col("least")),
            "most": F.when(narrow, F.col("hi")).otherwise(F.col("most")),
            "lo": F.when(narrow, lo).otherwise(moved["lo"]),
            "hi": F.when(narrow, hi).otherwise(moved["hi"]),
        }
    )
    return out.select(*STATE)


def _inside(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """Values of the groups with a bracket, up to its upper end; `v` is NULL below the lower end."""
    long = rows.select("__k", F.posexplode("__v").alias("c", "v")).where("v IS NOT NULL")
    found = lookup_join(long, brackets, ["__k", "c"], ["v"], hot_only=True).where(F.col("v") <= F.col("hi"))
    return found.withColumn("v", F.when(F.col("v") >= F.col("lo"), F.col("v")))


BRACKET = ["__k", "c", "m1", "m2", "lo", "hi", "least", "most", "size"]


def _sketched(found: DataFrame) -> DataFrame:
    return found.groupBy(*BRACKET).agg(
        F.count("v").alias("inside"), F.count_if(F.col("v").isNull()).alias("below"),
        F.kll_sketch_agg_double("v", F.lit(SKETCH)).alias("sketch"),
    )


def _counted(found: DataFrame) -> DataFrame:
    """State after counting the bracket's values: the median, or the bracket moved on if it missed a rank."""
    counts = found.groupBy(*BRACKET, "v").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("__k", "c").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.withColumn("upto", F.sum("n").over(running))

    def holds(m: str) -> Column:
        return F.col("v").isNotNull() & (F.col("upto") >= F.col(m)) & (F.col("upto") - F.col("n") < F.col(m))

    picked = summed.groupBy(*BRACKET).agg(
        F.max(F.when(holds("m1"), F.col("v"))).alias("v1"), F.max(F.when(holds("m2"), F.col("v"))).alias("v2"),
        F.coalesce(F.max(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0).cast("long")).alias("below"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0).cast("long")).alias("inside"),
    )
    covered = F.col("v1").isNotNull() & F.col("v2").isNotNull()
    return picked.withColumns(
        {
            "settled": covered,
            "median": F.when(covered, _mean(F.col("v1"), F.col("v2"))),
            "size": F.lit(2**62),
            **_moved(covered),
        }
    ).select(*STATE)


def geocode_by_cep(ads: DataFrame, medians: DataFrame, key: str = "url") -> DataFrame:
    """Set `latitude` and `longitude` from the ad's standardised postal code; NULL where unknown.

    One lookup per row of a table with one row per postal code; the ad keeps its raw code.
    """
    bare = ads.drop("latitude", "longitude").withColumn("__cep", standard_cep(F.col("cep")))
    table = medians.select(F.col("cep").alias("__cep"), "latitude", "longitude").filter(F.col("__cep").isNotNull())
    return lookup_join(bare, table, ["__cep"], [key], hot_only=True).drop("__cep")


def coordinates_with_fallback(ads: DataFrame, medians: DataFrame, vertices: DataFrame, key: str = "url") -> DataFrame:
    """Points outside the boundary take their postal code's coordinates where those exist.

    A point outside without such coordinates keeps what it has.
    """
    flagged = points_in_boundary(ads, vertices, [key]).withColumnsRenamed(
        {"latitude": "__lat", "longitude": "__lon"}
    )
    both = geocode_by_cep(flagged, medians, key)
    outside = ~F.col("inside")
    return both.withColumns(
        {
            "latitude": F.when(outside, F.coalesce("latitude", "__lat")).otherwise(F.col("__lat")),
            "longitude": F.when(outside, F.coalesce("longitude", "__lon")).otherwise(F.col("__lon")),
        }
    ).drop("inside", "__lat", "__lon")
