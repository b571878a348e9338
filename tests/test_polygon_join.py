"""Circles as polygons of many corners against hexagons and what a boundary leaves of them, next to plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from telhado.functions import geodesy, hexes
from telhado.operators import hexgrid, hexjoin
from telhado.session import materialise

R = geodesy.SPHERE_RADIUS
SIDE = hexes.side(hexes.SIZE)
# Boundary with a hole, and a splinter smaller than the widest circles.
SHAPE = [
    [(-40.7, -20.2), (-40.3, -20.25), (-40.25, -19.8), (-40.5, -19.95), (-40.7, -19.8)],
    [(-40.5, -20.1), (-40.45, -20.1), (-40.47, -20.06)],
    [(-40.1, -20.0), (-40.098, -20.0), (-40.099, -19.998)],
]


def flat(lon, lat):
    return math.radians(lon) * R, math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) * R


def degrees(x, y):
    return math.degrees(x / R), math.degrees(2 * math.atan(math.exp(y / R)) - math.pi / 2)


def in_ring(point, pairs):
    x, y = point
    odd = False
    for (x1, y1), (x2, y2) in pairs:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def cross(o, a, b):
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def meets(first, second):
    """Do two closed outlines, given as pairs of ends, share a point of their insides?"""
    for a, b in first:
        for c, d in second:
            if (cross(a, b, c) > 0) != (cross(a, b, d) > 0) and (cross(c, d, a) > 0) != (cross(c, d, b) > 0):
                return True
    return any(in_ring(a, second) for a, _ in first[:1]) or any(in_ring(c, first) for c, _ in second)


@pytest.fixture(scope="module")
def grid(spark):
    rows = [(k, i, x, y) for k, ring in enumerate(SHAPE) for i, (x, y) in enumerate(ring)]
    return materialise(hexgrid.hex_grid(spark.createDataFrame(rows, "ring int, seq int, x double, y double")), "polygon-grid")


def outlines(grid):
    corners = hexes.corners()
    found = {}
    for r in grid.collect():
        if r["outline"]:
            found[r["hex_id"]] = [((p["ax"], p["ay"]), (p["bx"], p["by"])) for p in r["outline"]]
        else:
            ring = [(r["cx"] + x, r["cy"] + y) for x, y in corners]
            found[r["hex_id"]] = list(zip(ring, ring[1:] + ring[:1]))
    return found


def rim_ads(spark, grid):
    """Circles whose rim passes within a metre of a side or a piece of some cell, from either side of it."""
    rnd = random.Random(5)
    rows = []
    for pairs in outlines(grid).values():
        for a, b in rnd.sample(pairs, min(4, len(pairs))):
            radius = rnd.choice([100.0, 1000.0, 1000.0, 4000.0])
            turn = math.atan2(b[1] - a[1], b[0] - a[0]) + rnd.choice([-1, 1]) * math.pi / 2
            t = rnd.uniform(-0.1, 1.1)
            x, y = a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t
            rows.append((len(rows), *degrees(x, y), radius, math.cos(turn), math.sin(turn), rnd.uniform(-1, 1) * radius / 1000))
    ads = spark.createDataFrame(rows, "ad_id int, longitude double, latitude double, dist_buffer double, c double, s double, gap double")
    axes = geodesy.mercator_reach(F.col("dist_buffer"), F.col("longitude"), F.col("latitude"))
    away = F.hypot(axes["x"] * F.col("c"), axes["y"] * F.col("s")) + F.col("gap")
    moved = ads.select(
        "ad_id", "dist_buffer",
        geodesy.mercator_lon(geodesy.mercator_x(F.col("longitude")) + away * F.col("c")).alias("longitude"),
        geodesy.mercator_lat(geodesy.mercator_y(F.col("latitude")) + away * F.col("s")).alias("latitude"),
    )
    return materialise(moved, "rim-ads")


def pairs_of(df):
    return {(r["ad_id"], r["hex_id"]) for r in df.select("ad_id", "hex_id").collect()}


@pytest.mark.parametrize("quarter", [2, 30])
def test_polygons_against_cells(spark, grid, quarter):
    ads = rim_ads(spark, grid)
    got = pairs_of(hexjoin.hex_join(ads, grid, ["ad_id"], quarter=quarter))
    centre = geodesy.utm_xy(F.col("longitude"), F.col("latitude"))
    drawn = ads.withColumn("centre", centre).withColumn(
        "drawn", geodesy.circle_ring(F.col("centre"), F.col("dist_buffer"), quarter=quarter)
    )
    cells = outlines(grid)
    want = set()
    for r in drawn.collect():
        ring = [flat(p["longitude"], p["latitude"]) for p in r["drawn"]]
        sides = list(zip(ring, ring[1:]))
        x, y = flat(r["longitude"], r["latitude"])
        reach = 2 * SIDE + 1.2 * r["dist_buffer"]
        near = {h for h, pairs in cells.items() if math.hypot(pairs[0][0][0] - x, pairs[0][0][1] - y) < reach}
        hits = {h for h in near if meets(sides, cells[h])}
        want |= {(r["ad_id"], h) for h in hits or {None}}
    assert got == want
    ellipses = pairs_of(hexjoin.hex_join(ads, grid, ["ad_id"]))
    assert len({p for p in ellipses - got if p[1] is not None}) > 10
    assert (len({p for p in got - ellipses if p[1] is not None}) == 0) or quarter == 30


def test_odd_rows(spark, grid):
    """No place, no radius, a radius of zero; copies; an empty table."""
    rows = [(1, None, -20.0, 100.0), (2, -40.5, -20.0, None), (3, -40.5, -20.0, 0.0), (3, -40.5, -20.0, 0.0), (4, -40.5, 89.0, 100.0)]
    ads = spark.createDataFrame(rows, "ad_id int, longitude double, latitude double, dist_buffer double")
    found = [(r["ad_id"], r["hex_id"]) for r in hexjoin.hex_join(ads, grid, ["ad_id"], quarter=30).collect()]
    plain = [(r["ad_id"], r["hex_id"]) for r in hexjoin.hex_join(ads, grid, ["ad_id"]).collect()]
    assert sorted(found, key=str) == sorted(plain, key=str) and len(found) == 5
    assert hexjoin.hex_join(ads.limit(0), grid, ["ad_id"], quarter=30).count() == 0
    with pytest.raises(ValueError, match="sides"):
        hexjoin.hex_join(ads.withColumn("sides", F.lit(1)), grid, ["ad_id"], quarter=30)
