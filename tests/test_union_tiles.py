"""The union of parts worked out tile by tile: what is kept of it, and edges along and across borders of tiles."""

import math
import random

import pytest

from telhado import session
from telhado.operators import boundary, overlay

VERTICES = "part int, ring int, seq int, x double, y double"
POINTS = "id int, longitude double, latitude double"


def rows(rings):
    return [(p, r, i, float(x), float(y)) for (p, r), ring in rings.items() for i, (x, y) in enumerate(ring)]


def inside_any(rings, x, y):
    odd = {}
    for (part, _), ring in rings.items():
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd[part] = not odd.get(part, False)
    return any(odd.values())


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


def board(step):
    """Squares with corners on a grid, side by side, one over two others, a hole with an island, a long bar across, a triangle."""
    rings = {(i, 0): square(step * (i % 4), step * (i // 4), step) for i in range(12) if i not in (5, 6)}
    rings |= {(20, 0): square(step * 3, step * 5, step * 2), (20, 1): square(step * 3.5, step * 5.5, step), (21, 0): square(step * 3.75, step * 5.75, step / 2)}
    rings |= {(22, 0): [(0, step * 5.5), (step * 8, step * 5.5), (step * 8, step * 6), (0, step * 6)], (23, 0): square(step * 6, step * 6, step)}
    # Two parts with a slanting side in common, of which one has a corner more on it.
    rings |= {(24, 0): [(step * 5, 0), (step * 8, step * 3), (step * 8, 0)], (25, 0): [(step * 5, 0), (step * 6, step), (step * 8, step * 3), (step * 5, step * 3)]}
    return rings


def stars(seed, parts=10, corners=30):
    rng = random.Random(seed)
    out = {}
    for p in range(parts):
        cx, cy, r = rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(1, 3)
        spokes = [rng.uniform(0.5, 1.0) for _ in range(corners)]
        for ring, size in ((0, 1.0), (1, 0.4)) if p % 3 == 0 else ((0, 1.0),):
            out[p, ring] = [
                (cx + size * r * s * math.cos(2 * math.pi * i / corners), cy + size * r * s * math.sin(2 * math.pi * i / corners))
                for i, s in enumerate(spokes)
            ]
    return out


def comb(part, teeth, upright):
    step = 10 / teeth
    corners = [(-1.0, 0.0)]
    for i in range(teeth):
        corners += [(0.0, i * step), (10.0 + i * step / 100, i * step + step / 8), (10.0, i * step + step / 4), (0.0, i * step + step / 2)]
    corners.append((-1.0, 10.0))
    return {(part, 0): [(y, x) if upright else (x, y) for x, y in corners]}


def scattered(rings, n, seed):
    rng = random.Random(seed)
    xs, ys = zip(*[p for ring in rings.values() for p in ring])
    return [(i, rng.uniform(min(xs) - 1, max(xs) + 1), rng.uniform(min(ys) - 1, max(ys) + 1)) for i in range(n)]


@pytest.mark.parametrize("rings", [board(1.0), stars(4)])
def test_borders_of_tiles(spark, monkeypatch, rings):
    """The same outline and the same points inside, whether one tile holds all edges or few."""
    vertices = spark.createDataFrame(rows(rings), VERTICES)
    points = scattered(rings, 2000, 3)
    table = spark.createDataFrame(points, POINTS)
    found = []
    for each in (1_000_000, 1):
        monkeypatch.setattr(overlay, "EDGES_PER_TILE", each)
        outline = overlay.dissolve(overlay.part_edges(vertices)).toPandas()
        ends = [sorted(zip(outline[f"x{i}"], outline[f"y{i}"])) for i in (1, 2)]
        assert ends[0] == ends[1]
        found.append(sorted(tuple(round(v, 9) + 0.0 for v in e) for e in outline[["x1", "y1", "x2", "y2"]].values))
        got = {r["id"]: r["inside"] for r in boundary.points_in_boundary(table, vertices, ["id"]).collect()}
        assert got == {i: inside_any(rings, x, y) for i, x, y in points}
    assert found[0] == found[1]


def test_slanting_sides_in_common(spark):
    """Parts on both sides of a slanting line, one with corners between that rounding puts beside it."""
    rng, rings = random.Random(1), {}
    for k in range(6):
        ax, ay, bx, by = (rng.uniform(0, 10) for _ in range(4))
        nx, ny = (by - ay) / 4, (ax - bx) / 4
        side = [(ax + (bx - ax) * c, ay + (by - ay) * c) for c in [0, *sorted(rng.random() for _ in range(3)), 1]]
        rings[2 * k, 0] = [(ax, ay), (bx, by), (bx + nx, by + ny), (ax + nx, ay + ny)]
        rings[2 * k + 1, 0] = [*side, (bx - nx, by - ny), (ax - nx, ay - ny)]
    points = scattered(rings, 2000, 3)
    found = boundary.points_in_boundary(spark.createDataFrame(points, POINTS), spark.createDataFrame(rows(rings), VERTICES), ["id"])
    assert {r["id"]: r["inside"] for r in found.collect()} == {i: inside_any(rings, x, y) for i, x, y in points}


def test_nothing_as_large_as_the_meeting_points_is_kept(spark):
    """Two combs meet far more often than they have edges: tables written, and rows that change tasks, grow with the edges."""
    teeth = 60
    rings = comb(1, teeth, False) | comb(2, teeth, True)
    points = scattered(rings, 400, 6)
    before = len(session._written())
    found = boundary.points_in_boundary(spark.createDataFrame(points, POINTS), spark.createDataFrame(rows(rings), VERTICES), ["id"])
    assert {r["id"]: r["inside"] for r in found.collect()} == {i: inside_any(rings, x, y) for i, x, y in points}
    n = 8 * teeth + 4
    assert sum(spark.read.parquet(path).count() for path in session._written()[before:]) < 2 * n < teeth**2
    # Meeting points come up in the last step, behind which no row changes its task.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Repartition")


@pytest.mark.parametrize("per_task", [50_000, 100])
def test_points_without_a_place_and_other_columns(spark, monkeypatch, per_task):
    """Points keep all their columns; one without a coordinate is neither inside nor outside; many in one tile go to several tasks."""
    monkeypatch.setattr(overlay, "POINTS_PER_TASK", per_task)
    rings = board(1.0)
    schema = "id int, longitude double, latitude double, url string, tx int, seen array<timestamp>, more struct<a:string,b:decimal(9,2)>"
    table = spark.createDataFrame(
        [(0, None, 1.0), (1, 1.0, None), (2, None, None), (3, math.nan, 0.5), (4, 0.5, math.inf), (5, 99.0, 99.0), *[(i, 0.5, 0.5 + i / 1e4) for i in range(6, 900)]],
        POINTS,
    ).selectExpr("*", "concat('u', id) AS url", "id AS tx", "array(timestamp'2024-01-02 03:04:05') AS seen", "named_struct('a', if(id = 3, NULL, 'x'), 'b', cast(id AS decimal(9,2))) AS more")
    found = boundary.points_in_boundary(table, spark.createDataFrame(rows(rings), VERTICES), ["id"])
    assert found.drop("inside").schema.simpleString() == f"struct<{schema.replace(' int', ':int').replace(' double', ':double').replace(' string', ':string').replace(' array', ':array').replace(' struct', ':struct').replace(', ', ',')}>"
    assert sorted(found.drop("inside").collect(), key=lambda r: r["id"])[6:] == sorted(table.collect(), key=lambda r: r["id"])[6:]
    got = {r["id"]: r["inside"] for r in found.select("id", "inside").collect()}
    assert [got[i] for i in range(6)] == [None, None, None, False, False, False] and all(got[i] for i in range(6, 900))
    nothing = boundary.points_in_boundary(table, spark.createDataFrame([], VERTICES), ["id"])
    assert nothing.where("inside").isEmpty() and nothing.count() == 900
