"""Edges of closed rings, and tiles of the plane that they pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geodesy
from .joins import lookup_join


def boundary_edges(vertices: DataFrame, project: bool = False) -> DataFrame:
    """Directed edges (ring, seq, x1, y1, x2, y2) of closed rings.

    `seq` counts a ring's vertices from 0 without gaps. Each vertex finds its successor by
    an equi-join on (ring, seq), so a long ring spreads over tasks. With `project`, degrees
    become Mercator metres; edges are straight between projected vertices.
    """
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    if project:
        x, y = geodesy.mercator_x(x), geodesy.mercator_y(y)
    points = vertices.select("ring", F.col("seq").cast("int").alias("seq"), x.alias("x"), y.alias("y"))
    sizes = vertices.groupBy("ring").agg(F.count(F.lit(1)).cast("int").alias("n"))
    following = points.select(
        "ring", F.col("seq").alias("next"), F.col("x").alias("x2"), F.col("y").alias("y2")
    )
    return (
        lookup_join(points, sizes, ["ring"], ["seq"])
        .withColumn("next", F.pmod(F.col("seq") + 1, F.col("n")))
        .join(following, ["ring", "next"])
        .select("ring", "seq", F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2")
    )


@dataclass(frozen=True)
class Extent:
    """How many edges there are, the box around them, and their mean width and height."""

    n: int
    low_x: float
    high_x: float
    low_y: float
    high_y: float
    mean_x: float
    mean_y: float


def extent_of(edges: DataFrame) -> Extent:
    found = edges.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(g(f"{a}1", f"{a}2")).alias(f"{n}_{a}") for a in "xy" for n, f, g in (("low", F.min, F.least), ("high", F.max, F.greatest))],
        *[F.avg(F.abs(F.col(f"{a}2") - F.col(f"{a}1"))).alias(f"mean_{a}") for a in "xy"],
    ).head()
    return Extent(**{k: v or 0 for k, v in found.asDict().items()})


# Where in a tile its spot lies, as a part of its width and height.
SPOT = 0.4771


@dataclass(frozen=True)
class Tiles:
    """Tiles of one size: about as many in the box as there are edges, or one for `each` of them, none narrower or lower than a mean edge."""

    wide: float
    high: float

    @classmethod
    def for_edges(cls, extent: Extent, each: int = 1) -> Tiles:
        across = max(1.0, (extent.n / each) ** 0.5)
        return cls(
            max((extent.high_x - extent.low_x) / across, extent.mean_x) or 1.0,
            max((extent.high_y - extent.low_y) / across, extent.mean_y) or 1.0,
        )

    def of_point(self, x: Column, y: Column) -> dict[str, Column]:
        return {"tx": F.floor(x / self.wide).cast("bigint"), "ty": F.floor(y / self.high).cast("bigint")}

    def of_edges(self, edges: DataFrame) -> DataFrame:
        """Each edge with the tiles (tx, ty) it passes: its rows of tiles, and in each the columns between its ends there."""

        def numbers(low: Column, high: Column, size: float) -> Column:
            # An edge that runs along a border of tiles, or ends at one, belongs to both sides of it.
            margin = size * 1e-9
            return F.sequence(F.floor((low - margin) / size).cast("bigint"), F.floor((high + margin) / size).cast("bigint"))

        rows = edges.withColumn("ty", F.explode(numbers(F.least("y1", "y2"), F.greatest("y1", "y2"), self.high)))
        rise = F.col("y2") - F.col("y1")

        def x_at(border: Column) -> Column:
            t = F.when(rise == 0, 0.0).otherwise((border - F.col("y1")) / rise)
            return F.col("x1") + (F.col("x2") - F.col("x1")) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))

        ends = [x_at(F.col("ty") * self.high), x_at((F.col("ty") + 1) * self.high)]
        from_x = F.when(rise == 0, F.least("x1", "x2")).otherwise(F.least(*ends))
        to_x = F.when(rise == 0, F.greatest("x1", "x2")).otherwise(F.greatest(*ends))
        return rows.withColumn("tx", F.explode(numbers(from_x, to_x, self.wide)))

    def spot(self, axis: str, number: Column | None = None) -> Column:
        """A place in the tile (tx, ty), off its middle so that no edge is likely to run through it."""
        number = F.col(f"t{axis}") if number is None else number
        return (number + SPOT) * (self.wide if axis == "x" else self.high)

    def spots_inside(self, edges: DataFrame, extent: Extent, by: tuple[str, ...] = ()) -> DataFrame:
        """(*by, tx, ty) of the tiles whose spot lies inside the rings, even-odd, of each `by`.

        Row by row, an edge that crosses the level of the spots turns all spots on its left; what is inside lies between
        every second of these places and the next.
        """
        # Tiles are as high as a mean edge at least, so an edge has a few rows on average.
        rows = edges.withColumn(
            "ty", F.explode(F.sequence(*[F.floor(f("y1", "y2") / self.high).cast("bigint") for f in (F.least, F.greatest)]))
        )
        level = self.spot("y")
        at = (F.col("x2") - F.col("x1")) * (level - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
        crossed = rows.where((F.col("y1") > level) != (F.col("y2") > level)).select(*by, "ty", at.alias("at"))
        guess = F.floor(F.col("at") / self.wide - SPOT).cast("bigint")
        last = F.when(self.spot("x", guess) >= F.col("at"), guess - 1).when(self.spot("x", guess + 1) < F.col("at"), guess + 1).otherwise(guess)
        turned = crossed.groupBy(*by, "ty", last.alias("last")).agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1")
        ends = turned.groupBy(*by, "ty").agg(F.sort_array(F.collect_list("last")).alias("ends"))
        # Rings that do not close leave the start of a row inside; a tile more than the box is told of.
        start = F.array(F.lit(int(extent.low_x // self.wide) - 2).cast("bigint"))
        ends = ends.withColumn("ends", F.when(F.size("ends") % 2 == 1, F.concat(start, "ends")).otherwise(F.col("ends")))
        spans = F.transform(
            F.sequence(F.lit(1), (F.size("ends") / 2).cast("int")),
            lambda i: F.sequence(F.element_at("ends", 2 * i - 1) + 1, F.element_at("ends", 2 * i)),
        )
        return ends.select(*by, "ty", F.explode(spans).alias("span")).select(*by, F.explode("span").alias("tx"), "ty")
