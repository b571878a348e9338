"""Boundary rings and the points inside them.

Rings are one even-odd multi-polygon, so holes and islands need no dissolving; parts that may
overlap are told apart by a column `part` and dissolved first (`overlay.py`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .edges import Extent, Tiles, boundary_edges, extent_of  # noqa: F401
from .joins import lookup_join, refuse_columns
from .overlay import flag_in_union, outline_edges, part_edges


@dataclass(frozen=True)
class Slabs:
    """Edges grouped by horizontal slab: (slab, edges). An edge lies in every slab it spans."""

    table: DataFrame
    height: float


def edge_slabs(edges: DataFrame, extent: Extent | None = None) -> Slabs:
    """Slabs of one height: as many as half the edges (64 at least), but none lower than the mean edge.

    So a slab holds a few edges however long the boundary, and the table about two rows an edge.
    It is written: a boundary is small, and only its true size shows that to the planner.
    """
    extent = extent or extent_of(edges)
    height = max((extent.high_y - extent.low_y) / max(64, extent.n // 2), extent.mean_y) or 1.0
    lowest = F.floor(F.least("y1", "y2") / height).cast("bigint")
    highest = F.floor(F.greatest("y1", "y2") / height).cast("bigint")
    spread = edges.filter(F.col("y1") != F.col("y2")).select(
        F.explode(F.sequence(lowest, highest)).alias("slab"), F.struct("x1", "y1", "x2", "y2").alias("edge")
    )
    grouped = spread.groupBy("slab").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    return Slabs(materialise(grouped, "boundary-slabs"), height)


def flag_inside(
    points: DataFrame, slabs: Slabs, x: str, y: str, spread_by: list[str], name: str = "inside"
) -> DataFrame:
    """Add `name`: does the point lie inside the boundary? NULL for a point without coordinates.

    Even-odd ray cast. Only edges of the point's own slab can cross its ray, so the edges come
    by an equi-join on the slab number and a point is tested against a handful of them.
    """
    refuse_columns(points, {"slab", "edges", name})
    px, py = F.col(x), F.col(y)
    placed = points.withColumn("slab", F.floor(py / slabs.height).cast("bigint"))
    joined = lookup_join(placed, slabs.table, ["slab"], spread_by, hot_only=True)

    def crosses(e):
        spans = (e["y1"] > py) != (e["y2"] > py)
        return spans & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])

    crossings = F.coalesce(F.size(F.filter("edges", crosses)), F.lit(0))
    odd = F.when(F.col("edges").isNull(), False).otherwise(crossings % 2 == 1)
    return joined.withColumn(name, F.when(px.isNotNull() & py.isNotNull(), odd)).drop("slab", "edges")


@dataclass(frozen=True)
class Cover:
    """Tiles that hold a part of the inside: (tx, ty, inside, edges), `inside` told of the tile's own spot.

    `size` bounds the bytes of the table in memory.
    """

    table: DataFrame
    tiles: Tiles
    size: int

    def spot(self, axis: str) -> Column:
        return self.tiles.spot(axis)


def boundary_cover(edges: DataFrame) -> Cover:
    """Cover of the inside by tiles: whole ones without edges, and those that edges pass with just these edges.

    There are about as many tiles in the boundary's box as edges, so a tile has a few. Tiles
    outside are left out. Where the spots lie follows, row by row, from the edges that cross the level of
    the row's spots. The table is written once and read by every lookup.
    """
    extent = extent_of(edges)
    tiles = Tiles.for_edges(extent)
    passed = tiles.of_edges(edges).groupBy("tx", "ty").agg(F.sort_array(F.collect_list(F.struct("x1", "y1", "x2", "y2"))).alias("own"))
    whole = tiles.spots_inside(edges, extent).withColumn("inside", F.lit(True))
    table = whole.join(passed, ["tx", "ty"], "full").select("tx", "ty", F.coalesce("inside", F.lit(False)).alias("inside"), F.col("own").alias("edges"))
    kept = table.where(F.col("inside") | F.col("edges").isNotNull())
    # An edge passes three tiles on average at most, four along borders; tiles are as many as edges and the rim.
    size = 64 * (int(extent.n**0.5) + 4) ** 2 + 4 * 48 * extent.n
    return Cover(materialise(kept, "boundary-cover"), tiles, size)


def flag_covered(points: DataFrame, cover: Cover, x: str, y: str, spread_by: list[str], name: str = "inside") -> DataFrame:
    """Add `name`: does the point lie inside the boundary? NULL for a point without coordinates.

    A tile without edges decides by itself, by an equi-join. In a tile that edges pass, the point
    is on the side of the tile's spot unless the way there, level and then upright, crosses an odd number
    of the tile's edges.
    """
    refuse_columns(points, {"tx", "ty", "edges", "__spot", name})
    px, py = F.col(x), F.col(y)
    placed = points.withColumns(cover.tiles.of_point(px, py))
    table = cover.table.withColumnRenamed("inside", "__spot")
    joined = lookup_join(placed, table, ["tx", "ty"], spread_by, cover.size, hot_only=True)
    sx, sy = cover.spot("x"), cover.spot("y")

    def crosses(e: Column) -> Column:
        level = (e["y1"] > py) != (e["y2"] > py)
        at_x = (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        upright = (e["x1"] > sx) != (e["x2"] > sx)
        at_y = (e["y2"] - e["y1"]) * (sx - e["x1"]) / (e["x2"] - e["x1"]) + e["y1"]
        return (level & ((px < at_x) != (sx < at_x))) != (upright & ((py < at_y) != (sy < at_y)))

    # An edge that crosses both parts of the way changes nothing, so it counts as crossing neither.
    odd = F.coalesce(F.size(F.filter("edges", crosses)), F.lit(0)) % 2 == 1
    inside = F.coalesce(F.col("__spot"), F.lit(False)) != F.when(F.col("edges").isNull(), False).otherwise(odd)
    return joined.withColumn(name, F.when(px.isNotNull() & py.isNotNull(), inside)).drop("tx", "ty", "edges", "__spot")


def points_in_boundary(points: DataFrame, vertices: DataFrame, spread_by: list[str]) -> DataFrame:
    """Add `inside` to points with `longitude` and `latitude`, against rings in degrees, or the union of their parts."""
    if "part" in vertices.columns:
        return flag_in_union(points, part_edges(vertices), "longitude", "latitude", spread_by)
    edges = materialise(outline_edges(vertices), "outline")
    return flag_covered(points, boundary_cover(edges), "longitude", "latitude", spread_by)


def points_outside_boundary(points: DataFrame, vertices: DataFrame, spread_by: list[str]) -> DataFrame:
    return points_in_boundary(points, vertices, spread_by).filter(~F.col("inside"))
