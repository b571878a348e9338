"""Union of boundary parts that may overlap: the outline of everything inside any part.

Each part is an even-odd polygon of its own rings. Edges are split where they meet, pieces that several
parts share become one segment, and a segment belongs to the outline of the union if exactly one of
its sides lies inside any part. With that outline the plain even-odd test is right again, for points
and for clipping alike.

There may be as many meeting points as pairs of edges, and as many pieces. So only edges are dealt out, to the tiles they
pass; where they meet, and what is outline, is worked out within each tile (`functions/outlines.py`) and leaves it as
pieces of the outline, or, where the points come to the same tile, only as what is asked of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions import outlines
from ..session import materialise
from .edges import SPOT, Tiles, boundary_edges, extent_of
from .joins import SALT, lookup_join, refuse_columns

ENDS = ["x1", "y1", "x2", "y2"]
# A tile has so many edges on average, over the whole box, unless that makes it smaller than an edge.
EDGES_PER_TILE = 256
# A tile with no more points than this goes to one task.
POINTS_PER_TASK = 50_000

def part_edges(vertices: DataFrame, project: bool = False) -> DataFrame:
    """Directed edges (part, ring, seq, x1, y1, x2, y2); a ring's number counts within its part."""
    keyed = vertices.withColumn("ring", F.struct("part", "ring"))
    return boundary_edges(keyed, project).select(
        F.col("ring.part").alias("part"), F.col("ring.ring").alias("ring"), "seq", "x1", "y1", "x2", "y2"
    )


def lesser_end_first(edges: DataFrame) -> DataFrame:
    """(edge, part, x1, y1, x2, y2): edges with a number, the end of lesser x, then y, first.

    Those without length, or without a part or a coordinate, are left out.
    """
    ends = [F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2)]
    known = edges.dropna(subset=["part", *ENDS]).withColumns({"a": F.least(*ends), "b": F.greatest(*ends)}).where(F.col("a") != F.col("b"))
    return known.select(
        F.monotonically_increasing_id().alias("edge"), "part",
        F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"),
    )


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """`rows` over as many tasks as a shuffle has, those of a tile together and in order."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys, "kind", "edge")


def tile_rows(edges: DataFrame) -> tuple[DataFrame, Tiles]:
    """(tx, ty, kind, edge, number, x1, y1, x2, y2): numbered edges in all tiles they pass, and the parts in which a tile's spot lies.

    `edges` are as from `part_edges`; a part's number is that of its first edge.
    """
    edges = materialise(lesser_end_first(edges), "part-edges")
    extent = extent_of(edges)
    tiles = Tiles.for_edges(extent, EDGES_PER_TILE)
    numbers = materialise(edges.groupBy("part").agg(F.min("edge").alias("number")), "part-numbers")
    numbered = lookup_join(edges, numbers, ["part"], ["edge"])
    spots = tiles.spots_inside(numbered, extent, ("number",)).select("tx", "ty", F.lit(outlines.SPOT).alias("kind"), "number")
    passed = tiles.of_edges(numbered).select("tx", "ty", F.lit(outlines.EDGE).alias("kind"), "edge", "number", *ENDS)
    return passed.unionByName(spots, allowMissingColumns=True), tiles


def dissolve(edges: DataFrame) -> DataFrame:
    """Outline (ring, seq, x1, y1, x2, y2) of the union of all parts, interior on the left; ring and seq are 0.

    `edges` are as from `part_edges`. Pieces are written once; those that a border of tiles cuts are put together again.
    """
    rows, tiles = tile_rows(edges)
    of_tiles = outlines.outlines(tiles.wide, tiles.high, SPOT, ["tx", "ty"])
    columns = "edge long, along double, ax double, ay double, bx double, by double, cut_a boolean, cut_b boolean, forward boolean"
    pieces = materialise(dealt(rows, "tx", "ty").mapInArrow(of_tiles, columns), "outline-pieces")
    way = Window.partitionBy("edge").orderBy("along")
    ends = {c: F.struct(f"{c}x", f"{c}y") for c in "ab"}
    goes_on = F.col("cut_a") & (F.lag(F.struct(ends["b"].alias("at"), "forward")).over(way) == F.struct(ends["a"].alias("at"), "forward"))
    cut = pieces.where("cut_a OR cut_b").withColumn("begins", ~F.coalesce(goes_on, F.lit(False)))
    joined = (
        cut.withColumn("run", F.sum(F.col("begins").cast("int")).over(way)).groupBy("edge", "run", "forward")
        .agg(F.min_by(ends["a"], "along").alias("a"), F.max_by(ends["b"], "along").alias("b"))
        .select("forward", "a.*", "b.*")
    )
    outline = pieces.where("NOT (cut_a OR cut_b)").select("forward", "ax", "ay", "bx", "by").unionByName(joined)

    def end(first: str, second: str) -> Column:
        return F.when(F.col("forward"), F.col(first)).otherwise(F.col(second))

    return outline.select(
        F.lit(0).alias("ring"), F.lit(0).alias("seq"),
        end("ax", "bx").alias("x1"), end("ay", "by").alias("y1"), end("bx", "ax").alias("x2"), end("by", "ay").alias("y2"),
    )


def flag_in_union(points: DataFrame, edges: DataFrame, x: str, y: str, spread_by: list[str], name: str = "inside") -> DataFrame:
    """Add `name`: does the point lie inside the union of all parts? NULL for a point without coordinates.

    Points go to the tile they lie in. There the outline is worked out whole, with a cover of its inside by cells, and the points pass
    by it batch by batch; nothing that grows with the meeting points leaves a task. A tile with more points than a task has on
    average is given to so many tasks as make up for it, each with all its edges.
    """
    refuse_columns(points, {name})
    rows, tiles = tile_rows(edges)
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    placed = points.select(
        F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("row"), px.alias("x1"), py.alias("y1"),
        *[c.alias(k) for k, c in tiles.of_point(px, py).items()],
    )
    # Points without one of their coordinates belong to no tile.
    nowhere = F.col("tx").isNull() | F.col("ty").isNull()
    placed = placed.withColumns({t: F.when(~nowhere, F.col(t)) for t in ("tx", "ty")}).withColumn("kind", F.lit(outlines.POINT))
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialise(placed.where("tx IS NOT NULL").groupBy("tx", "ty").agg(F.count(F.lit(1)).alias("n")), "tile-points")
    share = max((counts.agg(F.sum("n")).head()[0] or 0) / tasks, POINTS_PER_TASK)
    # Fewer rows than there are tasks.
    split = F.broadcast(counts.select("tx", "ty", F.ceil(F.col("n") / share).cast("int").alias("ways")).where("ways > 1"))
    ways = F.when(F.col("tx").isNull(), tasks).otherwise(F.coalesce("ways", F.lit(1)))
    salt = F.pmod(F.xxhash64(*[F.col("row")[c] for c in spread_by]), ways).cast("int")
    spread = placed.join(split, ["tx", "ty"], "left").withColumn(SALT, salt).drop("ways")
    copies = rows.join(split, ["tx", "ty"], "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), ways - 1))).drop("ways")
    keys = ["tx", "ty", SALT]
    flags = outlines.points_inside(tiles.wide, tiles.high, SPOT, keys, name)
    together = dealt(copies.unionByName(spread, allowMissingColumns=True), *keys)
    return together.mapInArrow(flags, StructType([*points.schema.fields, StructField(name, BooleanType())]))


def outline_edges(vertices: DataFrame, project: bool = False) -> DataFrame:
    """Edges for the even-odd test: of all rings as they are, or of the union where `vertices` tell their `part`."""
    if "part" not in vertices.columns:
        return boundary_edges(vertices, project)
    return dissolve(part_edges(vertices, project))
