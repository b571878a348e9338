"""Assign ads, each with a circle around it, to every hexagon the circle touches."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geodesy, hexes
from ..functions.hexes import SIZE, centre_x, centre_y
from ..session import materialise
from .joins import lookup_join, refuse_columns

WORK_COLUMNS = {"mx", "my", "cell", "q", "r", "reach", "deep", "rx", "stretch", "corner", "near", "home", "home_whole"}
POLYGON_COLUMNS = {"outer", "inner", "looked", "ring", "sides"}

MARGIN = 10
# A circle of the UTM plane and its ellipse on the map part by less than this share of the reach,
# per sphere radius of reach: neither projection's scale changes faster.
SCALE_DRIFT = 4.0


def neighbourhoods(grid: DataFrame, rings: int = 1) -> DataFrame:
    """Per cell of the plane: the grid cells among itself and the rings around it (q, r, near).

    Cells just outside the grid are listed too, since circles reach in from there. `home` is the
    number of the cell itself, NULL off the grid; `home_whole` tells that no boundary cuts it.
    """
    offsets = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in hexes.neighbours(rings)])
    spread = grid.select("hex_id", "q", "r", "outline", F.explode(offsets).alias("o"))
    itself = (F.col("o.a") == 0) & (F.col("o.b") == 0)
    return spread.groupBy((F.col("q") - F.col("o.a")).alias("q"), (F.col("r") - F.col("o.b")).alias("r")).agg(
        F.sort_array(
            F.collect_list(F.struct("hex_id", F.col("q").alias("cq"), F.col("r").alias("cr"), "outline"))
        ).alias("near"),
        F.max(F.when(itself, F.col("hex_id"))).alias("home"),
        F.max(itself & (F.size("outline") == 0)).alias("home_whole"),
    )


def rings_for(reach: float | None, size: float = SIZE) -> int:
    """Rings of neighbours that hold every hexagon a circle of this radius can touch.

    Rows of hexagons lie one and a half sides apart and each is two sides high, so beyond n rings
    every hexagon is at least 1.5 n - 0.5 sides away from any point of the middle one.
    """
    return max(1, math.floor(((reach or 0.0) / hexes.side(size) + 0.5) / 1.5) + 1)


def rings_around(grid: DataFrame, largest: float, size: float = SIZE) -> int | None:
    """Rings for circles of at most `largest` metres near this grid; None for circles as wide as many cells.

    The map stretches by the secant of the latitude. Points MARGIN cells beyond the grid are too
    far off to touch it, so its own extent bounds the stretch.
    """
    edge = (grid.agg(F.max(F.abs("cy"))).head()[0] or 0.0) + MARGIN * size
    # The metric plane's scale is 0.9996 at its middle and larger elsewhere; an ellipsoid adds under a hundredth.
    reach = largest * math.cosh(edge / geodesy.SPHERE_RADIUS) / 0.9996 * 1.01
    return rings_for(reach, size) if reach < (MARGIN - 1) * size else None


def with_cell(points: DataFrame, size: float = SIZE) -> DataFrame:
    """Add Mercator `mx`, `my` and the cell `q`, `r` of `longitude`, `latitude`.

    All four are NULL for coordinates that name no place on the map.
    """
    lon, lat = F.col("longitude"), F.col("latitude")
    on_map = lon.between(-180.0, 180.0) & lat.between(-85.0, 85.0)
    placed = points.withColumns(
        {"mx": F.when(on_map, geodesy.mercator_x(lon)), "my": F.when(on_map, geodesy.mercator_y(lat))}
    )
    return placed.withColumn("cell", hexes.cell_of(F.col("mx"), F.col("my"), size)).withColumns(
        {"q": F.col("cell.q"), "r": F.col("cell.r")}
    ).drop("cell")


def _in_outline(outline: Column, x: Column, y: Column) -> Column:
    """Even-odd test against the outline's own pieces."""
    crossing = F.filter(
        outline,
        lambda p: ((p["ay"] > y) != (p["by"] > y))
        & (x < (p["bx"] - p["ax"]) * (y - p["ay"]) / (p["by"] - p["ay"]) + p["ax"]),
    )
    return F.size(crossing) % 2 == 1


def _near_outline(outline: Column, x: Column, y: Column, reach: Column, stretch: Column) -> Column:
    """Does a piece come within `reach` of the point, y stretched?"""
    return F.exists(
        outline,
        lambda p: hexes.segment_distance2(
            F.lit(0.0), F.lit(0.0),
            p["ax"] - x, (p["ay"] - y) * stretch, p["bx"] - x, (p["by"] - y) * stretch,
        )
        <= reach * reach,
    )


def _outer(reach: Column) -> Column:
    """Reach that a circle drawn on the UTM plane stays within for certain."""
    return reach * (reach * (SCALE_DRIFT / geodesy.SPHERE_RADIUS) + 1.0)


def _polygon_meets(sides: Column, cell: Column, size: float) -> Column:
    """Does a convex polygon share a point with a cell, or with what the boundary leaves of it?

    A polygon that crosses no piece of an outline lies inside of it or outside as a whole, as any
    of its corners does.
    """
    outline, spot = cell["outline"], sides[0]
    return F.when(F.size(outline) == 0, hexes.polygon_meets_hexagon(sides, cell["cx"], cell["cy"], size)).otherwise(
        F.exists(outline, lambda p: hexes.polygon_meets_segment(sides, p)) | _in_outline(outline, spot["ax"], spot["ay"])
    )


def hex_join(
    ads: DataFrame,
    grid: DataFrame,
    spread_by: list[str],
    radius: str = "dist_buffer",
    size: float = SIZE,
    zone: int = 24,
    rings: int | None = None,
    largest: float | None = None,
    quarter: int | None = None,
) -> DataFrame:
    """One row per ad and touched hexagon, with `hex_id`; an ad that touches none keeps one row, NULL there.

    An ad looks up the list of grid cells around its own cell and tests its circle against
    each: one join, no re-join and no pairs to discard. How many rings of neighbours are looked
    at follows from the largest circle on the Mercator plane, which one aggregate finds; a
    caller that knows it may give `rings`, or the `largest` radius in metres, and save that pass.

    Circles are ellipses on the map. With `quarter` they are the polygons of 4 x `quarter` corners
    that `geodesy.circle_ring` draws, and the polygon itself is laid against the clipped cell. Its
    corners are worked out only for ads with a cell so near the circle's rim that the ellipse
    cannot tell.
    """
    refuse_columns(ads, WORK_COLUMNS if quarter is None else WORK_COLUMNS | POLYGON_COLUMNS)
    reach = geodesy.mercator_reach(F.col(radius), F.col("longitude"), F.col("latitude"), zone)
    placed = with_cell(ads, size).withColumn("reach", F.when(F.col("mx").isNotNull(), reach))
    if rings is None and largest is not None:
        rings = rings_around(grid, largest, size)
    if rings is None:
        rings = rings_for(placed.agg(F.max(_outer(F.greatest("reach.x", "reach.y")))).head()[0], size)
    # Most circles lie inside their own cell; those need no look at the neighbours.
    own_x = F.col("mx") - centre_x(F.col("q"), F.col("r"), size)
    own_y = F.col("my") - centre_y(F.col("r"), size)
    placed = placed.withColumns(
        {
            "deep": hexes.inside_hexagon(own_x, own_y, _outer(F.greatest("reach.x", "reach.y")), size),
            "rx": F.col("reach.x"),
            "stretch": F.try_divide("reach.x", "reach.y"),
        }
    ).withColumn("corner", F.col("stretch") * (hexes.side(size) / 2)).drop("reach")
    near = materialise(neighbourhoods(grid, rings), "neighbourhoods")
    # Nested outlines take many times the bytes of their file: count them.
    held = F.aggregate("near", F.lit(96), lambda a, c: a + 64 + 40 * F.size(c["outline"]))
    joined = lookup_join(placed, near, ["q", "r"], spread_by, held, hot_only=True)
    x, y, rx, stretch, corner = (F.col(c) for c in ("mx", "my", "rx", "stretch", "corner"))

    def folded(c: Column) -> Column:
        cx, cy = centre_x(c["cq"], c["cr"], size), centre_y(c["cr"], size)
        return F.struct(
            c["hex_id"].alias("hex_id"),
            c["outline"].alias("outline"),
            F.abs(x - cx).alias("u"),
            (F.abs(y - cy) * stretch).alias("v"),
            *([] if quarter is None else [cx.alias("cx"), cy.alias("cy")]),
        )

    def touched(c: Column, reach: Column) -> Column:
        in_box = (c["u"] <= reach + size / 2) & (c["v"] <= reach + corner * 2)
        near = in_box & hexes.touches_hexagon(c["u"], c["v"], reach, corner, size)
        whole = F.size(c["outline"]) == 0
        return near & (whole | _near_outline(c["outline"], x, y, reach, stretch) | _in_outline(c["outline"], x, y))

    cells = F.transform("near", folded)
    if quarter is None:
        looked = F.filter(cells, lambda c: touched(c, rx))
    else:
        sagitta = 1 - math.cos(math.pi / (4 * quarter))
        inner = F.greatest(rx * (1 - sagitta) - (_outer(rx) - rx), F.lit(0.0))
        joined = joined.withColumns({"outer": _outer(rx), "inner": inner})
        joined = joined.withColumn("looked", F.filter(cells, lambda c: touched(c, F.col("outer"))))
        joined = joined.withColumn(
            "looked", F.transform("looked", lambda c: c.withField("sure", touched(c, F.col("inner"))))
        )
        # Each step is a column of its own: one read several times would be worked out as often.
        centre = geodesy.utm_xy(F.col("longitude"), F.col("latitude"), zone)
        joined = joined.withColumn("ring", F.when(F.exists("looked", lambda c: ~c["sure"]), centre))
        ring = F.transform(
            geodesy.circle_ring(F.col("ring"), F.col(radius), zone, quarter=quarter),
            lambda p: F.struct(
                geodesy.mercator_x(p["longitude"]).alias("x"), geodesy.mercator_y(p["latitude"]).alias("y")
            ),
        )
        joined = joined.withColumn("ring", F.when(F.col("ring").isNotNull(), ring))
        joined = joined.withColumn("sides", hexes.polygon_sides(F.col("ring")))
        looked = F.filter("looked", lambda c: c["sure"] | _polygon_meets(F.col("sides"), c, size))
    found = F.transform(looked, lambda c: c["hex_id"])
    hits = F.when(F.col("deep") & (F.col("home_whole") | F.col("home").isNull()), F.array("home")).otherwise(found)
    return joined.select(*[F.col(f"`{c}`") for c in ads.columns], F.explode_outer(hits).alias("hex_id"))
