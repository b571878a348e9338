"""Where pairs of edges meet: the code that runs in Python workers."""

from __future__ import annotations

import sys
from fractions import Fraction
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle

# Sent along with the task, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Points = tuple[np.ndarray, np.ndarray]


def _cross(a: Points, b: Points, c: Points, d: Points) -> np.ndarray:
    """Cross product of the ways from a to b and from c to d; where rounding could tell the sign, it is worked out exactly."""
    left, right = (b[0] - a[0]) * (d[1] - c[1]), (b[1] - a[1]) * (d[0] - c[0])
    out = left - right
    same = ((a[0] == c[0]) & (a[1] == c[1]) & (b[0] == d[0]) & (b[1] == d[1])) | ((a[0] == d[0]) & (a[1] == d[1]) & (b[0] == c[0]) & (b[1] == c[1]))
    unsure = ((left != 0) | (right != 0)) & (np.abs(out) <= (np.abs(left) + np.abs(right)) * 2.0**-50) & ~same
    out[same] = 0.0
    for k in np.flatnonzero(unsure):
        ax, ay, bx, by, cx, cy, dx, dy = (Fraction(float(v[k])) for p in (a, b, c, d) for v in p)
        out[k] = float((bx - ax) * (dy - cy) - (by - ay) * (dx - cx))
    return out


def turn(a: Points, b: Points, p: Points) -> np.ndarray:
    """Above zero where p lies on the left of the line from a to b, zero on it."""
    out = _cross(a, b, a, p)
    out[((p[0] == a[0]) & (p[1] == a[1])) | ((p[0] == b[0]) & (p[1] == b[1]))] = 0.0
    return out


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return ((p > 0) & (q > 0)) | ((p < 0) & (q < 0))


def _crossing(a: Points, b: Points, c: Points, d: Points, sides: list[np.ndarray], cross: np.ndarray) -> Points:
    """The place where two edges meet. An end keeps its own coordinates, so that pieces of both edges have the very same ends."""
    oa, ob, oc, od = sides
    out = []
    for i in (0, 1):
        low = np.maximum(np.minimum(a[i], b[i]), np.minimum(c[i], d[i]))
        high = np.minimum(np.maximum(a[i], b[i]), np.maximum(c[i], d[i]))
        with np.errstate(all="ignore"):
            at = np.clip(a[i] + oa / cross * (b[i] - a[i]), low, high)
        out.append(np.select([oc == 0, od == 0, oa == 0, ob == 0], [c[i], d[i], a[i], b[i]], at))
    return out[0], out[1]


class Meetings(NamedTuple):
    """Places where edges meet others, ends and overlaps included; `row` and `other` are numbers of edges.

    `along` orders the places of an edge. `turns` tells that the other edge passes from one side to the other, an end on the
    line taken as lying on its right: then what lies just left of the edge changes for the other's part. `shared` tells
    that both edges lie on one line.
    """

    row: np.ndarray
    other: np.ndarray
    along: np.ndarray
    x: np.ndarray
    y: np.ndarray
    turns: np.ndarray
    shared: np.ndarray


def meetings(first: Points, last: Points, i: np.ndarray, j: np.ndarray) -> Meetings:
    """For pairs i < j of edges, lesser ends first: for either the places where the other meets it."""
    a, b, c, d = ((p[0][k], p[1][k]) for k in (i, j) for p in (first, last))
    cross = _cross(a, b, c, d)
    sides = [turn(c, d, a), turn(c, d, b), turn(a, b, c), turn(a, b, d)]
    meet = (cross != 0) & ~_apart(*sides[:2]) & ~_apart(*sides[2:])
    one, line = np.flatnonzero(meet), np.flatnonzero((cross == 0) & (sides[2] == 0))
    spot = _crossing(*[(p[0][one], p[1][one]) for p in (a, b, c, d)], [s[one] for s in sides], cross[one])
    pair = np.concatenate([one, *[line] * 4])
    x, y = (np.concatenate([spot[k], *[p[k][line] for p in (a, b, c, d)]]) for k in (0, 1))
    shared = np.arange(len(pair)) >= len(one)
    out = []
    for e, o, start, end, other in ((i, j, a, b, sides[2:]), (j, i, c, d, sides[:2])):
        x1, y1, x2, y2 = (v[pair] for v in (*start, *end))
        inside = (x1 <= x) & (x <= x2) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))
        at_end = ((x == x1) & (y == y1)) | ((x == x2) & (y == y2))
        turns = ~shared & ~at_end & ((other[0][pair] > 0) != (other[1][pair] > 0))
        along = (x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)
        keep = inside & (shared | ~at_end)
        out.append([v[keep] for v in (e[pair], o[pair], along, x, y, turns, shared)])
    return Meetings(*[np.concatenate(v) for v in zip(*out)])
