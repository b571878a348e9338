"""Boundary, grid and hexagon join against brute force on invented shapes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from telhado.functions import geodesy, rings
from telhado.operators import boundary, hexgrid, hexjoin
from telhado.session import materialise

R = geodesy.SPHERE_RADIUS
SIZE = 5000.0
SIDE = SIZE / math.sqrt(3)


def star(seed, n, radius, centre=(-40.5, -20.0), clockwise=False):
    rnd = random.Random(seed)
    ring = []
    for i in range(n):
        turn = 2 * math.pi * (i + rnd.uniform(-0.3, 0.3)) / n
        reach = radius * rnd.uniform(0.6, 1.0)
        ring.append((centre[0] + reach * math.cos(turn), centre[1] + reach * math.sin(turn)))
    return ring[::-1] if clockwise else ring


# An outer ring drawn clockwise, a hole, and an island apart.
SHAPE = [star(1, 40, 0.3, clockwise=True), star(2, 9, 0.08), star(3, 6, 0.05, (-40.0, -19.7))]


def vertices(spark, shape=SHAPE):
    rows = [(k, i, x, y) for k, ring in enumerate(shape) for i, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, "ring int, seq int, x double, y double")


def flat(x, y):
    return np.radians(x) * R, np.log(np.tan(np.pi / 4 + np.radians(y) / 2)) * R


def inside(shape, x, y):
    odd = np.zeros(np.shape(x), dtype=bool)
    for ring in shape:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            spans = (y1 > y) != (y2 > y)
            if y1 != y2:
                odd ^= spans & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return odd


def cell_of(x, y):
    rf, qf = y / (1.5 * SIDE), x / SIZE - y / (3 * SIDE)
    sf = -qf - rf
    q, r, s = np.rint(qf), np.rint(rf), np.rint(sf)
    dq, dr, ds = abs(q - qf), abs(r - rf), abs(s - sf)
    q_off = (dq > dr) & (dq > ds)
    r_off = ~q_off & (dr > ds)
    return np.where(q_off, -r - s, q).astype(int), np.where(r_off, -q - s, r).astype(int)


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2


FLAT = [[tuple(float(v) for v in flat(x, y)) for x, y in ring] for ring in SHAPE]


@pytest.fixture(scope="module")
def grid(spark):
    return materialise(hexgrid.hex_grid(vertices(spark)), "grid")


def spots(spark, n=600):
    rnd = random.Random(5)
    rows = [
        (i, -40.5 + rnd.uniform(-0.4, 0.6), -20.0 + rnd.uniform(-0.4, 0.4), 1000.0 if i % 3 else 100.0) for i in range(n)
    ]
    rows += [(n, None, -20.0, 100.0), (n + 1, -40.5, None, 100.0), (n + 2, 10.0, 50.0, 1000.0)]
    rows += [(n + 3, 1e300, -20.0, 100.0), (n + 4, -40.5, float("nan"), 100.0), (n + 5, -40.5, -90.0, 100.0)]
    return spark.createDataFrame(rows, "ad_id int, longitude double, latitude double, dist_buffer double")


def check_inside(spark):
    got = boundary.points_in_boundary(spots(spark), vertices(spark), ["ad_id"]).collect()
    for r in got:
        if r["longitude"] is None or r["latitude"] is None:
            assert r["inside"] is None
        else:
            assert r["inside"] == bool(inside(SHAPE, r["longitude"], r["latitude"])), r
    assert len(got) == 606


def test_points_in_boundary(spark):
    check_inside(spark)


def test_points_in_boundary_without_broadcast(spark, shuffled_joins):
    check_inside(spark)


def test_cells_add_up_to_the_shape(spark, grid):
    cells = grid.withColumn("area", hexgrid.cell_area()).collect()
    total = sum(r["area"] for r in cells)
    signed = [abs(area(r)) for r in FLAT]
    assert total == pytest.approx(signed[0] - signed[1] + signed[2], rel=1e-9)
    assert all(0 < r["area"] <= SIZE * SIZE * math.sqrt(3) / 2 + 1e-3 for r in cells)
    assert len({(r["q"], r["r"]) for r in cells}) == len(cells)
    order = sorted(cells, key=lambda r: (r["r"], r["q"]))
    assert [r["hex_id"] for r in order] == list(range(1, len(cells) + 1))


def test_clipped_rings_have_the_same_area(spark, grid):
    border = grid.filter("is_border")
    drawn = border.select("hex_id", "outline").mapInPandas(
        rings.outline_rings, rings.POLYGONS
    )
    areas = {r["hex_id"]: r["area"] for r in border.withColumn("area", hexgrid.cell_area()).collect()}
    found = drawn.collect()
    assert len(found) == len(areas)
    for r in found:
        total = 0.0
        for polygon in r["polygons"]:
            x0, y0 = polygon[0][0]
            outer, *holes = [area([(p["x"] - x0, p["y"] - y0) for p in ring]) for ring in polygon]
            assert outer > 0 and all(h < 0 for h in holes)
            total += outer + sum(holes)
        assert total == pytest.approx(areas[r["hex_id"]], abs=20.0)


def test_wkt(spark, grid):
    texts = {r["hex_id"]: r["geometry_wkt"] for r in hexgrid.hex_wkt(grid).collect()}
    cells = {r["hex_id"]: r for r in grid.collect()}
    assert texts.keys() == cells.keys()
    for hex_id, text in texts.items():
        assert text.startswith(("POLYGON ((", "MULTIPOLYGON ((("))
        numbers = text.replace("MULTIPOLYGON", "").replace("POLYGON", "").replace("(", "").replace(")", "")
        x, y = flat(*np.array([p.split() for p in numbers.split(", ")], dtype=float).T)
        cell = cells[hex_id]
        assert np.hypot(x - cell["cx"], y - cell["cy"]).max() <= SIDE + 1
        if not cell["is_border"]:
            assert len(x) == 7


def check_join(spark, grid):
    ads = spots(spark)
    reach = geodesy.mercator_reach(F.col("dist_buffer"), F.col("longitude"), F.col("latitude"))
    centres = {r["ad_id"]: r for r in ads.withColumn("reach", reach).collect()}
    number = {(r["q"], r["r"]): r["hex_id"] for r in grid.collect()}
    got = {}
    for r in hexjoin.hex_join(ads, grid, ["ad_id"]).collect():
        got.setdefault(r["ad_id"], set()).add(r["hex_id"])
    assert got.keys() == centres.keys()

    turns, radii = np.meshgrid(np.linspace(0, 2 * np.pi, 240, endpoint=False), np.linspace(0, 1, 60))

    def sampled(r, scale):
        x, y = flat(r["longitude"], r["latitude"])
        px = x + radii * np.cos(turns) * r["reach"]["x"] * scale
        py = y + radii * np.sin(turns) * r["reach"]["y"] * scale
        keep = inside(FLAT, px, py)
        q, s = cell_of(px[keep], py[keep])
        return {number[c] for c in set(zip(q.tolist(), s.tolist()))}

    several = 0
    for ad_id, r in centres.items():
        hexes = got[ad_id]
        if ad_id >= 600:
            assert hexes == {None}
            continue
        found = hexes - {None}
        assert len(hexes) == 1 or None not in hexes
        assert sampled(r, 0.999) <= found <= sampled(r, 1.03), (ad_id, hexes)
        several += len(found) > 1
    assert several > 30


def test_hex_join(spark, grid):
    check_join(spark, grid)


def test_wide_circles_look_at_more_rings(spark, grid):
    assert [hexjoin.rings_for(r * SIDE) for r in (0, 0.99, 1.0, 2.4, 2.6)] == [1, 1, 2, 2, 3]
    assert hexjoin.rings_for(None) == 1
    ads = spots(spark).withColumn("dist_buffer", F.lit(6000.0))
    found, least, many = (
        sorted(map(str, hexjoin.hex_join(ads, grid, ["ad_id"], rings=n).select("ad_id", "hex_id").collect()))
        for n in (None, 1, 5)
    )
    assert found == many and len(least) < len(many)


def test_hex_join_without_broadcast(spark, grid, shuffled_joins):
    check_join(spark, grid)


def test_more_rings_change_nothing(spark, grid):
    one = hexjoin.hex_join(spots(spark), grid, ["ad_id"], rings=1).select("ad_id", "hex_id")
    two = hexjoin.hex_join(spots(spark), grid, ["ad_id"], rings=2).select("ad_id", "hex_id")
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_grid_without_broadcast(spark, grid, shuffled_joins):
    again = hexgrid.hex_grid(vertices(spark)).select("hex_id", "q", "r", "is_border")
    assert sorted(map(str, again.collect())) == sorted(map(str, grid.select(*again.columns).collect()))


def test_smaller_cells(spark):
    """Another cell size: areas add up, and a second ring of neighbours finds nothing more."""
    small = materialise(hexgrid.hex_grid(vertices(spark), 2000.0), "grid-2000")
    total = sum(r["area"] for r in small.withColumn("area", hexgrid.cell_area(2000.0)).collect())
    signed = [abs(area(r)) for r in FLAT]
    assert total == pytest.approx(signed[0] - signed[1] + signed[2], rel=1e-9)
    found = [
        sorted(map(str, hexjoin.hex_join(spots(spark), small, ["ad_id"], size=2000.0, rings=n).select("ad_id", "hex_id").collect()))
        for n in (1, 2)
    ]
    assert found[0] == found[1] and len(found[0]) > 700


def test_taken_column_names_are_refused(spark, grid):
    with pytest.raises(ValueError, match="corner"):
        hexjoin.hex_join(spots(spark).withColumn("corner", F.lit(1)), grid, ["ad_id"])
    with pytest.raises(ValueError, match="inside"):
        boundary.points_in_boundary(spots(spark).withColumn("inside", F.lit(1)), vertices(spark), ["ad_id"])


def test_long_outlines_chain_in_any_order():
    """A ring of many pieces in shuffled order, next to a small one; ends a little apart still meet."""
    def circle(n, radius, x0):
        spots = [(x0 + radius * math.cos(2 * math.pi * i / n), radius * math.sin(2 * math.pi * i / n)) for i in range(n)]
        return [
            {"ax": a[0], "ay": a[1], "bx": b[0] + 2e-4, "by": b[1] - 2e-4}
            for a, b in zip(spots, spots[1:] + spots[:1])
        ]

    pieces = circle(20_000, 1000.0, 0.0) + circle(5, 10.0, 5000.0)
    random.Random(7).shuffle(pieces)
    found = sorted(rings.chain_rings(pieces), key=len)
    assert [len(r) for r in found] == [6, 20_001]
    assert all(r[0] == r[-1] for r in found)
    # Without a start nearby the nearest one is taken.
    apart = [{"ax": a, "ay": b, "bx": c, "by": d} for a, b, c, d in ((0, 0, 4, 0), (5, 0, 5, 4), (5, 5, 0, 4), (0, 5, 0, 1))]
    assert [len(r) for r in rings.chain_rings(apart)] == [5]


def test_slabs_stay_near_two_rows_an_edge(spark):
    """Edges as high as the whole boundary do not fill every slab."""
    n = 400
    zigzag = [(0, i, float(i), 100.0 * (i % 2)) for i in range(n)]
    edges = boundary.boundary_edges(spark.createDataFrame(zigzag, "ring int, seq int, x double, y double"))
    slabs = boundary.edge_slabs(edges)
    assert slabs.table.selectExpr("sum(size(edges)) AS n").head()["n"] <= 3 * n
