"""Arithmetic of a pointy-topped hexagon grid on the Mercator plane.

`size` is the distance between opposite sides. Cells have axial coordinates (q, r);
centres lie at x = size (q + r/2), y = 1.5 side r, with side = size / sqrt(3). The
origin is that of the projection, so a cell keeps its coordinates from run to run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

SIZE = 5000.0
ROOT3 = math.sqrt(3.0)


def neighbours(rings: int = 1) -> list[tuple[int, int]]:
    """Axial offsets of a cell and the rings of cells around it: 7 for one ring."""
    span = range(-rings, rings + 1)
    return [(q, r) for q in span for r in span if abs(q + r) <= rings]


def side(size: float) -> float:
    return size / ROOT3


def centre_x(q: Column, r: Column, size: float = SIZE) -> Column:
    return (q + r / 2) * size


def centre_y(r: Column, size: float = SIZE) -> Column:
    return r * (1.5 * side(size))


def cell_of(x: Column, y: Column, size: float = SIZE) -> Column:
    """Struct (q, r) of the cell that holds a point: cube rounding of axial coordinates."""
    rf = y / (1.5 * side(size))
    qf = x / size - y / (3.0 * side(size))
    sf = -qf - rf
    q, r, s = (F.floor(v + 0.5) for v in (qf, rf, sf))
    dq, dr, ds = F.abs(q - qf), F.abs(r - rf), F.abs(s - sf)
    q_off = (dq > dr) & (dq > ds)
    r_off = ~q_off & (dr > ds)
    return F.struct(
        F.when(q_off, -r - s).otherwise(q).cast("int").alias("q"),
        F.when(r_off, -q - s).otherwise(r).cast("int").alias("r"),
    )


def corners(size: float = SIZE) -> list[tuple[float, float]]:
    """Corner offsets from the centre, counter-clockwise from the lower right."""
    h, e = size / 2, side(size)
    return [(h, -e / 2), (h, e / 2), (0.0, e), (-h, e / 2), (-h, -e / 2), (0.0, -e)]


def segment_distance2(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Squared distance from a point to a segment."""
    wx, wy = bx - ax, by - ay
    dx, dy = px - ax, py - ay
    along, length2 = dx * wx + dy * wy, wx * wx + wy * wy
    across = dx * wy - dy * wx
    return (
        F.when(along <= 0, dx * dx + dy * dy)
        .when(along >= length2, (px - bx) * (px - bx) + (py - by) * (py - by))
        .otherwise(across * across / length2)
    )


def inside_hexagon(dx: Column, dy: Column, margin: Column, size: float = SIZE) -> Column:
    """Is the point further than `margin` from every side, on the inner side?"""
    u, v = F.abs(dx), F.abs(dy)
    return (u + margin < size / 2) & (u / 2 + v * (ROOT3 / 2) + margin < size / 2)


def touches_hexagon(u: Column, v: Column, reach: Column, corner: Column, size: float = SIZE) -> Column:
    """Does a circle of radius `reach` around (u, v) meet the hexagon?

    (u, v) is the offset from the hexagon's centre, made positive and with y stretched so that
    the ellipse to be tested became a circle; `corner` is the y of the upright side's end, half a
    side stretched alike. By symmetry only two sides can be nearest: the upright one at x = h,
    and the slanted one from (h, corner) to the top (0, 2 corner).
    """
    h = size / 2
    line = corner * u + v * h - corner * (2 * h)
    slant2 = corner * corner + h * h
    along = (F.lit(h) - u) * h + (v - corner) * corner
    above = F.greatest(v - corner, F.lit(0.0))
    reach2 = reach * reach
    return (
        ((u <= h) & (line <= 0))
        | ((u - h) * (u - h) + above * above <= reach2)
        | ((along >= 0) & (along <= slant2) & (line * line <= reach2 * slant2))
        | (u * u + (v - corner * 2) * (v - corner * 2) <= reach2)
    )


def clip_to_hexagon(ax: Column, ay: Column, bx: Column, by: Column, size: float = SIZE) -> Column:
    """Part of a segment inside the hexagon, as parameters (t0, t1); empty where t0 > t1.

    Coordinates are offsets from the hexagon's centre.
    """
    h = size / 2
    lows: list[Column] = [F.lit(0.0)]
    highs: list[Column] = [F.lit(1.0)]
    for nx, ny in ((1.0, 0.0), (0.5, ROOT3 / 2), (-0.5, ROOT3 / 2)):
        start = ax * nx + ay * ny
        rate = (bx - ax) * nx + (by - ay) * ny
        parallel = F.abs(rate) < 1e-9
        t_minus, t_plus = (F.lit(-h) - start) / rate, (F.lit(h) - start) / rate
        inside = F.abs(start) <= h
        lows.append(F.when(parallel, F.when(inside, 0.0).otherwise(2.0)).otherwise(F.least(t_minus, t_plus)))
        highs.append(F.when(parallel, F.when(inside, 1.0).otherwise(-1.0)).otherwise(F.greatest(t_minus, t_plus)))
    return F.struct(F.greatest(*lows).alias("t0"), F.least(*highs).alias("t1"))


# A convex polygon as its sides: array of (ax, ay, bx, by), clockwise, so that the outside lies on the left.


def _left_of(side: Column, x: Column, y: Column) -> Column:
    """Positive where a point lies outside of a polygon's side."""
    return (side["bx"] - side["ax"]) * (y - side["ay"]) - (side["by"] - side["ay"]) * (x - side["ax"])


def polygon_sides(ring: Column) -> Column:
    """Sides of a closed ring of (x, y)."""
    firsts, seconds = (F.slice(ring, F.lit(i), F.size(ring) - 1) for i in (1, 2))
    return F.zip_with(
        firsts, seconds,
        lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
    )


def polygon_meets_hexagon(sides: Column, cx: Column, cy: Column, size: float = SIZE) -> Column:
    """Do a convex polygon and the hexagon around a centre share a point? False if a side of either parts them.

    Of the six hexagon corners only the farthest along a polygon side's inner normal counts, which
    by symmetry has a closed form.
    """
    h, e = size / 2, side(size)

    def parts(s: Column) -> Column:
        wx, wy = s["bx"] - s["ax"], s["by"] - s["ay"]
        farthest = F.greatest(F.abs(wy) * h + F.abs(wx) * (e / 2), F.abs(wx) * e)
        return _left_of(s, cx, cy) > farthest

    def all_beyond(nx: float, ny: float) -> Column:
        return F.forall(sides, lambda s: (s["ax"] - cx) * nx + (s["ay"] - cy) * ny > h)

    apart = F.exists(sides, parts)
    for nx, ny in ((1.0, 0.0), (0.5, ROOT3 / 2), (-0.5, ROOT3 / 2)):
        apart = apart | all_beyond(nx, ny) | all_beyond(-nx, -ny)
    return ~apart


def polygon_meets_segment(sides: Column, p: Column) -> Column:
    """Do a convex polygon and a segment (ax, ay, bx, by) share a point? The segment is cut at each side's line."""

    def crossing(s: Column, entering: bool) -> Column:
        start, end = _left_of(s, p["ax"], p["ay"]), _left_of(s, p["bx"], p["by"])
        at = F.try_divide(start, start - end)
        if entering:
            return F.when(start <= 0, 0.0).when(end <= 0, at).otherwise(2.0)
        return F.when((start <= 0) & (end > 0), at).otherwise(1.0)

    enters = F.array_max(F.transform(sides, lambda s: crossing(s, True)))
    leaves = F.array_min(F.transform(sides, lambda s: crossing(s, False)))
    return enters <= leaves
