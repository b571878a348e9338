"""The union of overlapping boundary parts against the test "inside any part"."""

import math
import random
import time

import pytest

from telhado.operators import boundary, hexgrid, overlay

VERTICES = "part int, ring int, seq int, x double, y double"
SQUARES = {
    # Two overlapping squares; one sharing a whole side with the first; one inside; a copy; a side that overlaps in part.
    (1, 0): [(0, 0), (4, 0), (4, 4), (0, 4)],
    (2, 0): [(2, 2), (6, 2), (6, 6), (2, 6)],
    (3, 0): [(-3, 0), (-3, 4), (0, 4), (0, 0)],
    (4, 0): [(1, 1), (2, 1), (2, 2), (1, 2)],
    (5, 0): [(0, 0), (0, 4), (4, 4), (4, 0)],
    (6, 0): [(6, 3), (8, 3), (8, 9), (6, 9)],
    # A ring with a hole, an island in the hole, and a part that covers half the hole.
    (7, 0): [(10, 0), (20, 0), (20, 10), (10, 10)],
    (7, 1): [(12, 2), (18, 2), (18, 8), (12, 8)],
    (8, 0): [(14, 4), (15, 4), (15, 5), (14, 5)],
    (9, 0): [(16, 1), (19, 1), (19, 9), (16, 9)],
}


def stars(seed, parts=12, corners=40):
    rng = random.Random(seed)
    out = {}
    for p in range(parts):
        cx, cy, r = rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(1, 3)
        spokes = [rng.uniform(0.6, 1.0) for _ in range(corners)]
        for ring, size in ((0, 1.0), (1, 0.4)) if p % 3 == 0 else ((0, 1.0),):
            out[p, ring] = [
                (cx + size * r * s * math.cos(2 * math.pi * i / corners), cy + size * r * s * math.sin(2 * math.pi * i / corners))
                for i, s in enumerate(spokes)
            ]
    return out


def rows(rings):
    return [(p, r, i, float(x), float(y)) for (p, r), ring in rings.items() for i, (x, y) in enumerate(ring)]


def inside_any(rings, x, y):
    odd = {}
    for (part, _), ring in rings.items():
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd[part] = not odd.get(part, False)
    return any(odd.values())


@pytest.mark.parametrize("rings", [SQUARES, stars(1), stars(2)])
def test_points_in_union(spark, rings):
    rng = random.Random(9)
    xs, ys = zip(*[p for ring in rings.values() for p in ring])
    points = [(i, rng.uniform(min(xs) - 1, max(xs) + 1), rng.uniform(min(ys) - 1, max(ys) + 1)) for i in range(4000)]
    table = spark.createDataFrame(points, "id int, longitude double, latitude double")
    found = boundary.points_in_boundary(table, spark.createDataFrame(rows(rings), VERTICES), ["id"])
    got = {r["id"]: r["inside"] for r in found.collect()}
    assert got == {i: inside_any(rings, x, y) for i, x, y in points}


def test_outline_of_squares(spark):
    """Directed edges close up, the interior is on their left, and shared sides are gone."""
    edges = overlay.dissolve(overlay.part_edges(spark.createDataFrame(rows(SQUARES), VERTICES))).collect()
    area = sum(e["x1"] * e["y2"] - e["x2"] * e["y1"] for e in edges) / 2
    # Squares 1 to 6: 16 + 16 - 4 + 12 + 12. The frame: 100 - 36, island 1, what the cover adds inside the hole 12.
    assert area == pytest.approx(16 + 16 - 4 + 12 + 12 + 100 - 36 + 1 + 12)
    starts, ends = sorted((e["x1"], e["y1"]) for e in edges), sorted((e["x2"], e["y2"]) for e in edges)
    assert starts == ends
    assert not any(e["x1"] == e["x2"] == 0 and 0 < (e["y1"] + e["y2"]) / 2 < 4 for e in edges)


def test_grid_over_parts_equals_grid_over_their_union(spark):
    """Two halves with a common strip give the cells and areas of the whole."""
    whole = [(-41.0, -20.0), (-40.0, -20.0), (-40.0, -19.5), (-41.0, -19.5)]
    halves = {
        (1, 0): [(-41.0, -20.0), (-40.4, -20.0), (-40.4, -19.5), (-41.0, -19.5)],
        (2, 0): [(-40.6, -20.0), (-40.0, -20.0), (-40.0, -19.5), (-40.6, -19.5)],
    }

    def cells(vertices):
        grid = hexgrid.hex_grid(vertices)
        return {(r["q"], r["r"], r["is_border"]): r["area"] for r in grid.withColumn("area", hexgrid.cell_area()).collect()}

    one = cells(spark.createDataFrame(rows({(1, 0): whole}), VERTICES).drop("part"))
    two = cells(spark.createDataFrame(rows(halves), VERTICES))
    assert set(one) == set(two)
    assert all(abs(one[c] - two[c]) < 1.0 for c in one)


def comb(part, teeth, upright):
    """A comb of thin teeth on a back, the teeth 10 long and a unit of 10 / teeth apart."""
    step = 10 / teeth
    corners = [(-1.0, 0.0)]
    for i in range(teeth):
        corners += [(0.0, i * step), (10.0 + i * step / 100, i * step + step / 8), (10.0, i * step + step / 4), (0.0, i * step + step / 2)]
    corners.append((-1.0, 10.0))
    return {(part, 0): [(y, x) if upright else (x, y) for x, y in corners]}


def test_crossing_combs(spark):
    """All teeth cross all others: many more meeting points than edges, each looked at once.

    A look along a slab at all pieces of that height does not end in the time given.
    """
    rings = comb(1, 150, False) | comb(2, 150, True)
    started = time.monotonic()
    outline = overlay.dissolve(overlay.part_edges(spark.createDataFrame(rows(rings), VERTICES))).toPandas()
    assert time.monotonic() - started < 240
    assert len(outline) > 4 * 150 * 150
    ends = [sorted(zip(outline[f"x{i}"], outline[f"y{i}"])) for i in (1, 2)]
    assert ends[0] == ends[1]
    rng = random.Random(4)
    points = [(i, rng.uniform(-2, 11), rng.uniform(-2, 11)) for i in range(500)]
    table = spark.createDataFrame(points, "id int, longitude double, latitude double")
    edges = spark.createDataFrame(outline)
    got = {r["id"]: r["inside"] for r in boundary.flag_covered(table, boundary.boundary_cover(edges), "longitude", "latitude", ["id"]).collect()}
    assert got == {i: inside_any(rings, x, y) for i, x, y in points}


def test_part_that_crosses_itself(spark):
    """A bow tie half under a square, a ring drawn twice and a part drawn by two others' sides."""
    rings = {
        (1, 0): [(0, 0), (4, 4), (4, 0), (0, 4)],
        (2, 0): [(1, 1), (3, 1), (3, 3), (1, 3)],
        (3, 0): [(6, 0), (8, 0), (8, 2), (6, 2)],
        (3, 1): [(6, 0), (8, 0), (8, 2), (6, 2)],
        (4, 0): [(7, 0), (9, 0), (9, 2), (7, 2)],
    }
    points = [(i, -0.53 + 0.21 * (i % 50), -0.47 + 0.19 * (i // 50)) for i in range(1500)]
    table = spark.createDataFrame(points, "id int, longitude double, latitude double")
    found = boundary.points_in_boundary(table, spark.createDataFrame(rows(rings), VERTICES), ["id"])
    assert {r["id"]: r["inside"] for r in found.collect()} == {i: inside_any(rings, x, y) for i, x, y in points}
