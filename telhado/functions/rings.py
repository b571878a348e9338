"""Closed rings from the outline pieces of border cells: the code that runs in Python workers."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle

# Sent along with the task, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POLYGONS = "hex_id int, polygons array<array<array<struct<x: double, y: double>>>>"


def chain_rings(pieces: list[dict], tolerance: float = 1e-3) -> list[list[tuple[float, float]]]:
    """Closed rings from directed pieces laid end to start (ends meet within `tolerance`).

    Starts are found by their place on a lattice of `tolerance`. Only where none lies next to an
    end is the nearest of all taken.
    """
    left = {i: ((p["ax"], p["ay"]), (p["bx"], p["by"])) for i, p in enumerate(pieces)}

    def spot(point: tuple[float, float]) -> tuple[int, int]:
        return int(point[0] // tolerance), int(point[1] // tolerance)

    starts: dict[tuple[int, int], list[int]] = {}
    for i, (a, _) in left.items():
        starts.setdefault(spot(a), []).append(i)

    def gap(end: tuple[float, float], i: int) -> float:
        a = left[i][0]
        return max(abs(end[0] - a[0]), abs(end[1] - a[1]))

    def take(i: int) -> tuple[tuple[float, float], tuple[float, float]]:
        starts[spot(left[i][0])].remove(i)
        return left.pop(i)

    rings = []
    while left:
        start, end = take(next(reversed(left)))
        ring = [start]
        while left and max(abs(end[0] - start[0]), abs(end[1] - start[1])) > tolerance:
            x, y = spot(end)
            near = [i for u in (x - 1, x, x + 1) for v in (y - 1, y, y + 1) for i in starts.get((u, v), ())]
            a, end = take(min(near or left, key=lambda i: gap(end, i)))
            ring.append(a)
        rings.append([*ring, start])
    return [r for r in rings if len(r) > 3]


def _ring_area(ring: list[tuple[float, float]]) -> float:
    x0, y0 = ring[0]
    return sum((a[0] - x0) * (b[1] - y0) - (b[0] - x0) * (a[1] - y0) for a, b in zip(ring, ring[1:])) / 2


def _in_ring(point: tuple[float, float], ring: list[tuple[float, float]]) -> bool:
    x, y = point
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def outline_rings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per border cell: its polygons, each an outer ring followed by its holes, in Mercator metres."""
    for frame in frames:
        polygons = []
        for pieces in frame["outline"]:
            rings = chain_rings([p if isinstance(p, dict) else p.asDict() for p in pieces])
            outer = [[r] for r in rings if _ring_area(r) > 0]
            for hole in (r for r in rings if _ring_area(r) <= 0):
                owner = next((o for o in outer if _in_ring(hole[0], o[0])), outer[0] if outer else None)
                if owner is not None:
                    owner.append(hole)
            polygons.append([[[{"x": x, "y": y} for x, y in r] for r in group] for group in outer])
        yield pd.DataFrame({"hex_id": frame["hex_id"], "polygons": polygons})
