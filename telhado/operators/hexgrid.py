"""Hexagon cells over a boundary: cover, clipped outlines, numbering, WKT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import geodesy, hexes
from ..functions.hexes import ROOT3, SIZE, centre_x, centre_y, side
from ..functions.rings import POLYGONS, outline_rings
from ..session import materialise
from .boundary import edge_slabs, flag_inside
from .joins import union_all
from .overlay import outline_edges

PIECE = "struct<ax: double, ay: double, bx: double, by: double>"
# A piece of the outline within this distance of a cell side counts as ending on it (metres).
ON_SIDE = 1e-5
# How far to the left of an outline piece its inner side is probed (metres).
PROBE = 0.01


def _offset(name: str, axis: str, size: float) -> Column:
    centre = centre_x(F.col("q"), F.col("r"), size) if axis == "x" else centre_y(F.col("r"), size)
    return F.col(name) - centre


def boundary_pieces(edges: DataFrame, size: float = SIZE) -> DataFrame:
    """Every boundary edge cut to the cells it passes: (q, r, ring, seq, ax, ay, bx, by).

    An edge lists the grid rows it spans and, per row, the columns between its ends within
    that row; an exact clip then decides. No edge meets a cell it is nowhere near.
    """
    e = side(size)
    step = 1.5 * e
    rows = edges.withColumn(
        "r",
        F.explode(
            F.sequence(
                F.ceil((F.least("y1", "y2") - e) / step).cast("int"),
                F.floor((F.greatest("y1", "y2") + e) / step).cast("int"),
            )
        ),
    )
    rise = F.col("y2") - F.col("y1")
    low, high = centre_y(F.col("r"), size) - e, centre_y(F.col("r"), size) + e
    t_low = F.when(rise == 0, 0.0).otherwise(F.least((low - F.col("y1")) / rise, (high - F.col("y1")) / rise))
    t_high = F.when(rise == 0, 1.0).otherwise(F.greatest((low - F.col("y1")) / rise, (high - F.col("y1")) / rise))
    run = F.col("x2") - F.col("x1")
    strip = rows.withColumns(
        {
            "xa": F.col("x1") + run * F.greatest(F.lit(0.0), F.least(F.lit(1.0), t_low)),
            "xb": F.col("x1") + run * F.greatest(F.lit(0.0), F.least(F.lit(1.0), t_high)),
        }
    )
    cells = strip.withColumn(
        "q",
        F.explode(
            F.sequence(
                F.ceil((F.least("xa", "xb") - size / 2) / size - F.col("r") / 2).cast("int"),
                F.floor((F.greatest("xa", "xb") + size / 2) / size - F.col("r") / 2).cast("int"),
            )
        ),
    )
    clip = hexes.clip_to_hexagon(
        _offset("x1", "x", size), _offset("y1", "y", size), _offset("x2", "x", size), _offset("y2", "y", size), size
    )
    cut = cells.withColumn("clip", clip).filter(F.col("clip.t0") <= F.col("clip.t1"))
    return cut.select(
        "q",
        "r",
        "ring",
        "seq",
        (F.col("x1") + run * F.col("clip.t0")).alias("ax"),
        (F.col("y1") + rise * F.col("clip.t0")).alias("ay"),
        (F.col("x1") + run * F.col("clip.t1")).alias("bx"),
        (F.col("y1") + rise * F.col("clip.t1")).alias("by"),
    )


def cells_in_box(edges: DataFrame, size: float = SIZE) -> DataFrame:
    """All cells (q, r) whose centre lies in the bounding box of the edges, a cell wider all round.

    Rows are spread over tasks before each lists its columns.
    """
    step = 1.5 * side(size)
    box = edges.agg(
        F.min(F.least("x1", "x2")).alias("x0"), F.max(F.greatest("x1", "x2")).alias("x1"),
        F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("y1", "y2")).alias("y1"),
    )
    rows = box.withColumn(
        "r", F.explode(F.sequence(F.floor(F.col("y0") / step).cast("int"), F.ceil(F.col("y1") / step).cast("int")))
    ).repartition("r")
    first = F.floor(F.col("x0") / size - F.col("r") / 2).cast("int")
    last = F.ceil(F.col("x1") / size - F.col("r") / 2).cast("int")
    return rows.select(F.explode(F.sequence(first, last)).alias("q"), "r")


def _side_parts(border: DataFrame, size: float) -> DataFrame:
    """Sides of the border cells, cut where the boundary meets them: (q, r, ax, ay, bx, by)."""
    spots = hexes.corners(size)
    sides = F.array(
        *[
            F.struct(*[F.lit(v).alias(n) for v, n in zip((*a, *b), ("sx", "sy", "ex", "ey"))])
            for a, b in zip(spots, spots[1:] + spots[:1])
        ]
    )
    per_side = border.withColumn("side", F.explode(sides))
    cx, cy = centre_x(F.col("q"), F.col("r"), size), centre_y(F.col("r"), size)
    length = side(size)

    def along(p: Column) -> Column:
        ux, uy = F.col("side.ex") - F.col("side.sx"), F.col("side.ey") - F.col("side.sy")
        return ((p["x"] - F.col("side.sx")) * ux + (p["y"] - F.col("side.sy")) * uy) / (length * length)

    def on_side(p: Column) -> Column:
        d2 = hexes.segment_distance2(
            p["x"], p["y"], F.col("side.sx"), F.col("side.sy"), F.col("side.ex"), F.col("side.ey")
        )
        return d2 <= ON_SIDE * ON_SIDE

    ends = F.flatten(
        F.transform(
            "pieces",
            lambda p: F.array(
                F.struct((p["ax"] - cx).alias("x"), (p["ay"] - cy).alias("y")),
                F.struct((p["bx"] - cx).alias("x"), (p["by"] - cy).alias("y")),
            ),
        )
    )
    inner = F.filter(F.transform(F.filter(ends, on_side), along), lambda t: (t > 0) & (t < 1))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), inner)))
    spans = per_side.withColumn("cuts", cuts).select(
        "q", "r", "side",
        F.explode(F.arrays_zip(
            F.slice("cuts", F.lit(1), F.size("cuts") - 1).alias("t0"),
            F.slice("cuts", F.lit(2), F.size("cuts") - 1).alias("t1"),
        )).alias("span"),
    )

    def at(t: str, axis: str) -> Column:
        start, end = F.col(f"side.s{axis}"), F.col(f"side.e{axis}")
        return (cx if axis == "x" else cy) + start + (end - start) * F.col(f"span.{t}")

    return spans.select(
        "q", "r", at("t0", "x").alias("ax"), at("t0", "y").alias("ay"), at("t1", "x").alias("bx"), at("t1", "y").alias("by")
    )


def hex_cells(vertices: DataFrame, size: float = SIZE) -> DataFrame:
    """Cells that share area with the boundary: (q, r, is_border, outline).

    `outline` is empty for a whole cell. For a border cell it holds the directed pieces of
    the outline of (cell and boundary), interior on the left: boundary edges cut to the cell,
    and parts of the cell's sides that run inside the boundary.
    """
    edges = materialise(outline_edges(vertices, project=True), "hex-edges")
    slabs = edge_slabs(edges)
    pieces = materialise(boundary_pieces(edges, size), "hex-pieces")

    whole = cells_in_box(edges, size).join(pieces.select("q", "r").distinct(), ["q", "r"], "left_anti")
    whole = whole.withColumns(
        {"cx": centre_x(F.col("q"), F.col("r"), size), "cy": centre_y(F.col("r"), size)}
    )
    whole = flag_inside(whole, slabs, "cx", "cy", ["q", "r"]).filter("inside")

    border = pieces.groupBy("q", "r").agg(F.sort_array(F.collect_list(F.struct("ax", "ay", "bx", "by"))).alias("pieces"))
    drawn = pieces.select("q", "r", "ax", "ay", "bx", "by", F.lit(True).alias("drawn")).filter(
        (F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by"))
    )
    parts = union_all([drawn, _side_parts(border, size).withColumn("drawn", F.lit(False))])
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    length = F.sqrt(dx * dx + dy * dy)
    probe = F.when(F.col("drawn"), F.lit(PROBE)).otherwise(0.0)
    parts = parts.withColumns(
        {
            "mx": (F.col("ax") + F.col("bx")) / 2 - dy / length * probe,
            "my": (F.col("ay") + F.col("by")) / 2 + dx / length * probe,
        }
    )
    parts = flag_inside(parts, slabs, "mx", "my", ["q", "r", "ax", "ay"])
    # A side part outside the boundary is no outline; an edge with its inside on the right is turned.
    turned = F.col("drawn") & ~F.col("inside")
    outline = parts.filter(F.col("drawn") | F.col("inside")).select(
        "q",
        "r",
        F.when(turned, F.struct(F.col("bx").alias("ax"), F.col("by").alias("ay"), F.col("ax").alias("bx"), F.col("ay").alias("by")))
        .otherwise(F.struct("ax", "ay", "bx", "by"))
        .alias("piece"),
    )
    clipped = outline.groupBy("q", "r").agg(F.sort_array(F.collect_list("piece")).alias("outline"))
    return whole.select(
        "q", "r", F.lit(False).alias("is_border"), F.array().cast(f"array<{PIECE}>").alias("outline")
    ).unionByName(clipped.select("q", "r", F.lit(True).alias("is_border"), "outline"))


def number_cells(cells: DataFrame) -> DataFrame:
    """Add `hex_id`, 1 upwards by (r, q).

    Numbering runs per grid row on top of the row's starting number. Only the starting
    numbers are summed in one task: one value per grid row, under ten thousand for the
    whole projection at the default size.
    """
    per_row = cells.groupBy("r").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = per_row.select("r", (upto - F.col("n")).alias("start"))
    within = F.row_number().over(Window.partitionBy("r").orderBy("q"))
    return cells.withColumn("within", within).join(starts, "r").select(
        (F.col("start") + F.col("within")).cast("int").alias("hex_id"),
        *cells.columns,
    )


def hex_grid(vertices: DataFrame, size: float = SIZE) -> DataFrame:
    """Grid over a boundary in degrees: (hex_id, q, r, cx, cy, is_border, outline), in Mercator metres.

    A table of a few thousand cells, built once and read many times.
    """
    cells = materialise(hex_cells(vertices, size), "hex-cells")
    return number_cells(cells).select(
        "hex_id", "q", "r",
        centre_x(F.col("q"), F.col("r"), size).alias("cx"),
        centre_y(F.col("r"), size).alias("cy"),
        "is_border", "outline",
    )


def cell_area(size: float = SIZE) -> Column:
    """Area on the Mercator plane, in square metres, of the part of a cell inside the boundary."""
    # Offsets from the centre keep the sums small.
    shoelace = F.aggregate(
        "outline",
        F.lit(0.0),
        lambda total, p: total
        + (p["ax"] - F.col("cx")) * (p["by"] - F.col("cy"))
        - (p["bx"] - F.col("cx")) * (p["ay"] - F.col("cy")),
    )
    return F.when(F.col("is_border"), shoelace / 2).otherwise(size * size * ROOT3 / 2)


def whole_cell_wkt(size: float = SIZE, digits: int = 6) -> Column:
    spots = hexes.corners(size)
    ring = [
        geodesy.coordinate_text(
            geodesy.mercator_lon(F.col("cx") + dx), geodesy.mercator_lat(F.col("cy") + dy), digits
        )
        for dx, dy in [*spots, spots[0]]
    ]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *ring), F.lit("))"))


def hex_wkt(grid: DataFrame, size: float = SIZE, digits: int = 6) -> DataFrame:
    """(hex_id, geometry_wkt) in degrees: whole cells as hexagons, border cells clipped."""
    border = grid.filter("is_border").select("hex_id", "outline").mapInPandas(
        outline_rings, POLYGONS
    )

    def point(p: Column) -> Column:
        return geodesy.coordinate_text(geodesy.mercator_lon(p["x"]), geodesy.mercator_lat(p["y"]), digits)

    def ring(points: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(points, point), ", "), F.lit(")"))

    texts = F.transform(
        "polygons", lambda poly: F.concat(F.lit("("), F.array_join(F.transform(poly, ring), ", "), F.lit(")"))
    )
    clipped = border.select("hex_id", texts.alias("t")).select(
        "hex_id",
        F.when(F.size("t") == 1, F.concat(F.lit("POLYGON "), F.col("t")[0]))
        .otherwise(F.concat(F.lit("MULTIPOLYGON ("), F.array_join("t", ", "), F.lit(")")))
        .alias("geometry_wkt"),
    )
    whole = grid.filter(~F.col("is_border")).select("hex_id", whole_cell_wkt(size, digits).alias("geometry_wkt"))
    return whole.unionByName(clipped)
