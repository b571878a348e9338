"""Points against a boundary of very many vertices, by tiles."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from telhado.operators import boundary, edges

RINGS = "ring int, seq int, x double, y double"


def coast(n, seed=1):
    """A ragged ring of n vertices with a hole and an island."""
    rng = random.Random(seed)
    sizes, out = [(1.0, n * 8 // 10), (0.5, n // 10), (0.2, n // 10)], []
    for ring, (size, k) in enumerate(sizes):
        r = 1.0
        for i in range(k):
            r = min(1.2, max(0.8, r + rng.uniform(-0.02, 0.02)))
            angle = 2 * math.pi * i / k
            out.append((ring, i, -40 + size * r * math.cos(angle), -20 + size * r * math.sin(angle)))
    return out


def plain_inside(vertices, x, y):
    rings = {}
    for ring, _, a, b in vertices:
        rings.setdefault(ring, []).append((a, b))
    parts = [np.array([(*p, *q) for p, q in zip(r, r[1:] + r[:1])]) for r in rings.values()]
    x1, y1, x2, y2 = np.concatenate(parts).T
    out = []
    for px, py in zip(x, y):
        hit = np.flatnonzero((y1 > py) != (y2 > py))
        at = (x2[hit] - x1[hit]) * (py - y1[hit]) / (y2[hit] - y1[hit]) + x1[hit]
        out.append(bool((px < at).sum() % 2))
    return out


@pytest.mark.parametrize("n,points", [(50_000, 20_000), (40, 4000)])
def test_long_boundary(spark, n, points):
    vertices = coast(n)
    rng = random.Random(3)
    x = [-40 + rng.uniform(-1.3, 1.3) for _ in range(points)]
    y = [-20 + rng.uniform(-1.3, 1.3) for _ in range(points)]
    # Points right beside vertices, and far away.
    near = rng.sample(vertices, 30)
    x += [v[2] + 1e-7 for v in near] + [100.0, -40.0]
    y += [v[3] + 1e-7 for v in near] + [-20.0, 80.0]
    table = spark.createDataFrame(list(zip(range(len(x)), x, y)) + [(-1, None, -20.0)], "id int, longitude double, latitude double")
    rings = spark.createDataFrame(vertices, RINGS)
    cover = boundary.boundary_cover(edges.boundary_edges(rings))
    found = {r["id"]: r["inside"] for r in boundary.flag_covered(table, cover, "longitude", "latitude", ["id"]).collect()}
    assert found.pop(-1) is None
    assert [found[i] for i in range(len(x))] == plain_inside(vertices, x, y)
    tiles = cover.table.agg(F.max(F.size("edges")).alias("most"), F.sum(F.size("edges")).alias("edges"), F.count("*").alias("tiles")).head()
    assert tiles["edges"] <= 4 * n and tiles["tiles"] <= 3 * n + 200
    placed = table.where("id >= 0").withColumns(cover.tiles.of_point(F.col("longitude"), F.col("latitude"))).join(cover.table, ["tx", "ty"])
    assert placed.agg(F.sum(F.coalesce(F.size("edges"), F.lit(0)))).head()[0] < 5 * len(x)


def test_squares_on_tile_borders_and_no_boundary(spark):
    square = [(0, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)])]
    x, y = zip(*[(i / 4 + 0.01, j / 4 + 0.01) for i in range(-4, 20) for j in range(-4, 20)])
    table = spark.createDataFrame(list(zip(range(len(x)), x, y)), "id int, longitude double, latitude double")
    found = boundary.points_in_boundary(table, spark.createDataFrame(square, RINGS), ["id"]).collect()
    assert {r["id"]: r["inside"] for r in found} == dict(enumerate(plain_inside(square, x, y)))
    none = boundary.points_in_boundary(table, spark.createDataFrame([], RINGS), ["id"])
    assert none.where("inside").isEmpty() and none.count() == len(x)
