"""The outline of the union of parts within one tile of the plane, and points beside it: the code that runs in Python workers."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from .meetings import Meetings, meetings

# Sent along with the task, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs looked at together: this bounds the memory of a tile with very many edges.
BLOCK = 1 << 18
# Key of rows without a tile.
NOWHERE = -(1 << 62)


class Tile(NamedTuple):
    """The tile (tx, ty) of a grid, and the part of its width and height at which its spot lies."""

    tx: int
    ty: int
    wide: float
    high: float
    spot: float

    def spot_at(self) -> tuple[float, float]:
        return (self.tx + self.spot) * self.wide, (self.ty + self.spot) * self.high

    def holds(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (np.floor(x / self.wide) == self.tx) & (np.floor(y / self.high) == self.ty)


class Edges(NamedTuple):
    """Edges of a tile, ordered by their number: the lesser end first, parts numbered."""

    edge: np.ndarray
    part: np.ndarray
    x1: np.ndarray
    y1: np.ndarray
    x2: np.ndarray
    y2: np.ndarray

    def at(self, rows: np.ndarray) -> Edges:
        return Edges(*[v[rows] for v in self])


class Outline(NamedTuple):
    """Pieces (a, b) of the outline, each on an edge; `forward` tells that the interior is on the left of the way from a to b.

    `along` orders the pieces of an edge. `cut_a` and `cut_b` tell of ends that are there only because a border of
    the tile cuts the edge.
    """

    edge: np.ndarray
    along: np.ndarray
    ax: np.ndarray
    ay: np.ndarray
    bx: np.ndarray
    by: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    forward: np.ndarray

    def at(self, rows: np.ndarray) -> Outline:
        return Outline(*[v[rows] for v in self])


NO_OUTLINE = Outline(np.empty(0, "i8"), *[np.empty(0)] * 5, *[np.empty(0, bool)] * 3)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    if not len(keys[0]):
        return np.empty(0, "i8")
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _each(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges from low to high: the row of each number, and the number."""
    n = high - low + 1
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + low[row]


def near_pairs(e: Edges, tile: Tile) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs i < j of edges that may meet, block by block: neither lies wholly on one side of the other's line, by more than
    rounding can tell, and their boxes overlap. With each whether one lies along the other's line."""
    n = len(e.edge)
    x0, y0 = tile.tx * tile.wide, tile.ty * tile.high
    x1, y1, x2, y2 = e.x1 - x0, e.y1 - y0, e.x2 - x0, e.y2 - y0
    dx, dy, one = x2 - x1, y2 - y1, np.ones(n)
    lines = np.stack([-dy, dx, dy * x1 - dx * y1], axis=1)
    ends = [np.stack([x, y, one]) for x, y in ((x1, y1), (x2, y2))]
    most = max(np.abs(v).max() for v in (e.x1, e.y1, e.x2, e.y2, x1, y1, x2, y2))
    slack = (np.abs(dx) + np.abs(dy)) * most * 2.0**-46
    low, high = np.minimum(e.y1, e.y2), np.maximum(e.y1, e.y2)

    def met(of: slice, by: slice) -> np.ndarray:
        a, b = (lines[of] @ end[:, by] for end in ends)
        return (np.minimum(a, b) <= slack[of, None]) & (np.maximum(a, b) >= -slack[of, None])

    step = max(1, BLOCK // n)
    for begin in range(0, n, step):
        some, rest = slice(begin, min(begin + step, n)), slice(begin, n)
        i, j = np.nonzero(met(some, rest) & met(rest, some).T)
        later = i < j
        i, j = i[later] + begin, j[later] + begin
        boxes = (e.x1[i] <= e.x2[j]) & (e.x1[j] <= e.x2[i]) & (low[i] <= high[j]) & (low[j] <= high[i])
        i, j = i[boxes], j[boxes]
        # Whether both ends of one lie so near the other's line that only exact numbers tell the side.
        close = np.zeros(len(i), bool)
        for k, m in ((i, j), (j, i)):
            sides = [dx[k] * (v[m] - y1[k]) - dy[k] * (u[m] - x1[k]) for u, v in ((x1, y1), (x2, y2))]
            close |= (np.abs(sides[0]) <= slack[k]) & (np.abs(sides[1]) <= slack[k])
        yield i, j, close


def _border_cuts(e: Edges, tile: Tile, pairs: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """(row, x, y) where borders of the tile cut edges.

    `pairs` are edges on one line: those that a border cuts together are cut at the very same place, that of the first.
    """
    out = []
    for k in (0, 1):
        a, b = ((e.x1, e.x2), (e.y1, e.y2))[k]
        c, d = ((e.y1, e.y2), (e.x1, e.x2))[k]
        for border in ((tile.tx, tile.tx + 1), (tile.ty, tile.ty + 1))[k]:
            at = border * (tile.wide, tile.high)[k]
            over = (np.minimum(a, b) < at) & (at < np.maximum(a, b))
            rows = np.flatnonzero(over)
            with np.errstate(all="ignore"):
                other = np.clip(c + (at - a) / (b - a) * (d - c), np.minimum(c, d), np.maximum(c, d))
            first = np.arange(len(a))
            both = over[pairs[0]] & over[pairs[1]]
            np.minimum.at(first, pairs[1][both], pairs[0][both])
            place = [np.full(len(rows), at), other[first[rows]]]
            out.append([rows, *(place if k == 0 else place[::-1])])
    return [np.concatenate(v) for v in zip(*out)]


def _ahead_exactly(e: Edges, i: int, px: float, py: float, j: int) -> bool:
    """Whether, level from the place on edge i that is nearest to (px, py), edge j lies ahead; on one line, as seen from just left of i."""
    ax, ay, bx, by = (Fraction(float(v[i])) for v in e[2:])
    cx, cy, dx, dy = (Fraction(float(v[j])) for v in e[2:])
    px, py = Fraction(float(px)), Fraction(float(py))
    part = ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)
    px, py = ax + part * (bx - ax), ay + part * (by - ay)
    side = (dx - cx) * (py - cy) - (dy - cy) * (px - cx)
    return by > ay if side == 0 else (side > 0) == (dy > cy)


def _parts_beside(
    e: Edges, seeds: np.ndarray, px: np.ndarray, py: np.ndarray, tile: Tile, pairs: tuple[np.ndarray, np.ndarray], numbers: np.ndarray, at_spot: np.ndarray
) -> np.ndarray:
    """For seeds, places (px, py) on the edges `seeds`: which of the parts `numbers` lie just left of the edge there.

    That side is the one of the tile's spot, told by `at_spot`, unless the way there, level and then upright, crosses an odd
    number of a part's edges. `pairs` are edges of which one lies along the other's line.
    """
    sx, sy = tile.spot_at()
    by = np.argsort(e.part, kind="stable")
    _, x1, y1, x2, y2 = e.at(by)[1:]
    starts = np.searchsorted(e.part[by], numbers)
    column = np.empty(len(by), "i8")
    column[by] = np.arange(len(by))
    dx, dy = x2 - x1, y2 - y1
    # Edges along the seed's own line: left of a rising one they are ahead, left of a falling one behind.
    row_of = np.full(len(by), -1)
    row_of[seeds] = np.arange(len(seeds))
    one, two = (np.concatenate([p, q]) for p, q in (pairs, pairs[::-1]))
    known = row_of[one] >= 0
    one, two = one[known], two[known]
    told = (e.y2 > e.y1)[one]
    for k in np.flatnonzero((e.x1[one] != e.x1[two]) | (e.y1[one] != e.y1[two]) | (e.x2[one] != e.x2[two]) | (e.y2[one] != e.y2[two])):
        told[k] = _ahead_exactly(e, one[k], px[row_of[one[k]]], py[row_of[one[k]]], two[k])
    own_row, own_column = np.concatenate([np.arange(len(seeds)), row_of[one]]), column[np.concatenate([seeds, two])]
    own_ahead = np.concatenate([(e.y2 > e.y1)[seeds], told])
    order = np.argsort(own_row, kind="stable")
    own_row, own_column, own_ahead = own_row[order], own_column[order], own_ahead[order]
    out = np.empty((len(seeds), len(numbers)), bool)
    upright = np.flatnonzero((x1 > sx) != (x2 > sx))
    step = max(1, BLOCK // len(by))
    with np.errstate(all="ignore"):
        above = dy[upright] * (sx - x1[upright]) / dx[upright] + y1[upright]
        for begin in range(0, len(seeds), step):
            some = slice(begin, begin + step)
            qx, qy = px[some, None], py[some, None]
            at = qy - y1
            at *= dx
            at /= dy
            at += x1
            ahead = qx < at
            mine = slice(*np.searchsorted(own_row, [begin, begin + step]))
            ahead[own_row[mine] - begin, own_column[mine]] = own_ahead[mine]
            crossed = ((y1 > qy) != (y2 > qy)) & (ahead != (sx < at))
            crossed[:, upright] ^= (qy < above) != (sy < above)
            out[some] = np.logical_xor.reduceat(crossed, starts, axis=1)
    return out ^ at_spot


def _steps(rows: np.ndarray, other: np.ndarray, own_of: np.ndarray, seed_of: np.ndarray, seed_at: np.ndarray, places: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """By how much the parts on the left change at turns, in the order of their edges `rows` and `places` there: (all, the edge's own).

    A part's turns along an edge alternate between in and out; the seed tells with which they begin.
    """
    seed = seed_of[rows]
    before = places <= seed_at[seed]
    group = np.argsort(rows * beside.shape[1] + other, kind="stable")
    starts = _starts(rows[group], other[group])
    sizes = np.diff(np.append(starts, len(group)))
    rank = np.arange(len(group)) - np.repeat(starts, sizes) + 1
    after = np.empty(len(group), "i8")
    if len(group):
        after[group] = rank - np.repeat(np.add.reduceat(before[group].astype("i8"), starts), sizes)
    step = np.where(beside[seed, other] ^ (after % 2 == 1), 1, -1)
    return np.stack([step, np.where(other == own_of[rows], step, 0)])


def _of_several(part: np.ndarray, pieces: np.ndarray, n: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces (ax, ay, bx, by) on lines that edges share: the first of each on the outline, and the parts on its left that draw it.

    A piece that a part's own rings draw twice cancels out; of several parts, each counts once.
    """
    order = np.lexsort((np.arange(len(part)), part, *pieces))
    starts = _starts(part[order], *pieces[:, order])
    if not len(starts):
        return starts, starts
    odd = np.diff(np.append(starts, len(order))) % 2 == 1
    rows, n, own = order[starts][odd], np.maximum.reduceat(n[order], starts)[odd], np.maximum.reduceat(own[order], starts)[odd]
    starts = _starts(*pieces[:, rows])
    if not len(starts):
        return starts, starts
    owners = np.diff(np.append(starts, len(rows)))
    n, own, least = np.maximum.reduceat(n, starts), np.add.reduceat(own, starts), np.minimum.reduceat(rows, starts)
    kept = (n == own) & ((own == 0) | (own == owners))
    return least[kept], own[kept]


def outline_in(tile: Tile, e: Edges, inside_at_spot: np.ndarray) -> Outline:
    """Pieces within the tile of the outline of the union of all parts, cut at the tile's borders.

    `e` are all edges that pass the tile, `inside_at_spot` the numbers of all parts that its spot lies in. Edges are cut where they meet.
    Which parts lie just left of an edge is looked up once, at its longest piece in the tile; from piece to piece it changes
    only where another edge passes to the other side. Parts that lie on the left and do not own a piece lie on both
    sides; all others lie on one side.
    """
    numbers, own_of = np.unique(e.part, return_inverse=True)
    # A part without an edge here that holds the spot holds the whole tile.
    if not len(numbers) or not np.isin(inside_at_spot, numbers).all():
        return NO_OUTLINE
    count = len(e.edge)
    found, along_line = [], [(np.empty(0, "i8"),) * 2]
    for i, j, close in near_pairs(e, tile):
        found.append(meetings((e.x1, e.y1), (e.x2, e.y2), i, j))
        along_line.append((i[close], j[close]))
    along_line = [np.concatenate(v) for v in zip(*along_line)]
    met = Meetings(*[np.concatenate(v) for v in zip(*found)])
    del found
    lines = met.shared & (met.row < met.other)
    back = met.shared & (met.row > met.other)
    pairs = np.concatenate([met.row[lines], met.other[back]]), np.concatenate([met.other[lines], met.row[back]])
    cuts = _border_cuts(e, tile, pairs)
    every = np.arange(count)
    row = np.concatenate([met.row, every, every, cuts[0]])
    x, y = np.concatenate([met.x, e.x1, e.x2, cuts[1]]), np.concatenate([met.y, e.y1, e.y2, cuts[2]])
    along = (x - e.x1[row]) * (e.x2 - e.x1)[row] + (y - e.y1[row]) * (e.y2 - e.y1)[row]
    other = np.concatenate([own_of[met.other], np.zeros(len(row) - len(met.row), "i8")])
    turns = np.zeros(len(row), bool)
    turns[: len(met.row)] = met.turns
    cut = np.zeros(len(row), bool)
    cut[len(row) - len(cuts[0]) :] = True
    shared = np.zeros(count, bool)
    shared[met.row[met.shared]] = True
    del met

    order = np.lexsort((y, x, along, row))
    row, x, y, along, other, turns, cut = (v[order] for v in (row, x, y, along, other, turns, cut))
    starts = _starts(row, x, y)
    place = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(row))))
    p_row, p_x, p_y, p_along, p_cut = row[starts], x[starts], y[starts], along[starts], np.logical_and.reduceat(cut, starts)
    a = np.flatnonzero(p_row[1:] == p_row[:-1])
    mid_x, mid_y = (p_x[a] + p_x[a + 1]) / 2, (p_y[a] + p_y[a + 1]) / 2
    here = tile.holds(mid_x, mid_y)
    a, mid_x, mid_y = a[here], mid_x[here], mid_y[here]
    if not len(a):
        return NO_OUTLINE

    longest = np.lexsort((a, p_along[a] - p_along[a + 1], p_row[a]))
    longest = longest[_starts(p_row[a][longest])]
    seeds, seed_at = p_row[a[longest]], a[longest]
    beside = _parts_beside(e, seeds, mid_x[longest], mid_y[longest], tile, along_line, numbers, np.isin(numbers, inside_at_spot))
    seed_of = np.full(count, -1)
    seed_of[seeds] = np.arange(len(seeds))
    known = np.flatnonzero(turns & (seed_of[row] >= 0))
    step = np.zeros((2, len(p_row)), "i8")
    for total, change in zip(step, _steps(row[known], other[known], own_of, seed_of, seed_at, place[known], beside)):
        np.add.at(total, place[known], change)
    total = np.cumsum(step, axis=1)
    at_seed = np.stack([beside.sum(axis=1), beside[np.arange(len(seeds)), own_of[seeds]]])
    seed = seed_of[p_row[a]]
    n, own = at_seed[:, seed] + total[:, a] - total[:, seed_at[seed]]

    alone = ~shared[p_row[a]]
    single = np.flatnonzero(alone & (n == own) & ((own == 0) | (own == 1)))
    rest = np.flatnonzero(~alone)
    ends = np.stack([p_x[a[rest]], p_y[a[rest]], p_x[a[rest] + 1], p_y[a[rest] + 1]])
    several, owned = _of_several(own_of[p_row[a[rest]]], ends, n[rest], own[rest])
    a, own = np.concatenate([a[single], a[rest[several]]]), np.concatenate([own[single], owned])
    return Outline(e.edge[p_row[a]], p_along[a], p_x[a], p_y[a], p_x[a + 1], p_y[a + 1], p_cut[a], p_cut[a + 1], own > 0)


class TileCover:
    """Cells of a tile, each with the pieces of outline that pass it and whether its own spot lies inside.

    There are about as many cells as pieces, none narrower or lower than a mean piece, so a point meets a few pieces
    however many the tile has.
    """

    def __init__(self, tile: Tile, inside_at_spot: bool, outline: Outline):
        x1, y1, x2, y2 = self.ends = outline.ax, outline.ay, outline.bx, outline.by
        self.x0, self.y0 = tile.tx * tile.wide, tile.ty * tile.high
        n = max(1, len(x1))
        sizes = [max(size / n**0.5, np.abs(q - p).mean() if len(p) else 0.0) for size, p, q in ((tile.wide, x1, x2), (tile.high, y1, y2))]
        self.nx, self.ny = max(1, int(tile.wide / sizes[0])), max(1, int(tile.high / sizes[1]))
        self.wide, self.high = tile.wide / self.nx, tile.high / self.ny
        self.spot_x = self.x0 + (np.arange(self.nx) + tile.spot) * self.wide
        self.spot_y = self.y0 + (np.arange(self.ny) + tile.spot) * self.high
        sx, sy = tile.spot_at()
        margin = 1e-9
        rise = y2 - y1
        row, r = _each(self._row(np.minimum(y1, y2) - margin * self.high), self._row(np.maximum(y1, y2) + margin * self.high))
        a, b, c, d, up = x1[row], y1[row], x2[row], y2[row], rise[row]
        with np.errstate(all="ignore"):
            # In each row of cells, the columns between a piece's ends there.
            flat = up == 0
            at = [a + (c - a) * np.where(flat, k, np.clip((border - b) / up, 0.0, 1.0)) for k, border in ((0, self.y0 + r * self.high), (1, self.y0 + (r + 1) * self.high))]
            piece, column = _each(self._column(np.minimum(*at) - margin * self.wide), self._column(np.maximum(*at) + margin * self.wide))
            cell = r[piece] * self.nx + column
            order = np.argsort(cell, kind="stable")
            self.pieces = row[piece][order]
            self.begin = np.searchsorted(cell[order], np.arange(self.nx * self.ny + 1))
            # A piece that crosses the level of a row's spots turns all spots on its left.
            level = self.spot_y[r]
            crossed = (b > level) != (d > level)
            at = (c[crossed] - a[crossed]) * (level[crossed] - b[crossed]) / up[crossed] + a[crossed]
            r = r[crossed]
            turned = np.bincount(r * (self.nx + 1) + np.searchsorted(self.spot_x, at), minlength=self.ny * (self.nx + 1)).reshape(self.ny, self.nx + 1)
            beyond = np.cumsum(turned[:, ::-1], axis=1)[:, ::-1][:, 1:]
            beyond_spot = np.bincount(r, weights=sx < at, minlength=self.ny).astype("i8")
            upright = np.sort((rise * (sx - x1) / (x2 - x1) + y1)[(x1 > sx) != (x2 > sx)])
        above = [len(upright) - np.searchsorted(upright, v, side="right") for v in (self.spot_y, sy)]
        self.inside = ((inside_at_spot + above[0] + above[1] + beyond_spot)[:, None] + beyond) % 2 == 1

    def _column(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((x - self.x0) / self.wide), 0, self.nx - 1).astype("i8")

    def _row(self, y: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((y - self.y0) / self.high), 0, self.ny - 1).astype("i8")

    def holds(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether points of the tile lie inside: as the spot of their cell, unless the way there, level and then upright, crosses an
        odd number of the cell's pieces."""
        r, c = self._row(y), self._column(x)
        cell = r * self.nx + c
        out = self.inside[r, c]
        most = np.cumsum(self.begin[cell + 1] - self.begin[cell])
        for some in np.split(np.arange(len(x)), _starts(most // (4 * BLOCK))[1:]):
            point, k = _each(self.begin[cell[some]], self.begin[cell[some] + 1] - 1)
            point = some[point]
            x1, y1, x2, y2 = (v[self.pieces[k]] for v in self.ends)
            px, py, sx, sy = x[point], y[point], self.spot_x[c[point]], self.spot_y[r[point]]
            with np.errstate(all="ignore"):
                at_x = (x2 - x1) * (py - y1) / (y2 - y1) + x1
                at_y = (y2 - y1) * (sx - x1) / (x2 - x1) + y1
            level = ((y1 > py) != (y2 > py)) & ((px < at_x) != (sx < at_x))
            upright = ((x1 > sx) != (x2 > sx)) & ((py < at_y) != (sy < at_y))
            np.logical_xor.at(out, point, level != upright)
        return out


# Kinds of rows dealt to tiles, in the order in which a tile takes them.
SPOT, EDGE, POINT = 0, 1, 2


class TileRows:
    """What a tile has been given so far; its outline and cover are worked out once all its edges are there."""

    def __init__(self, tile: Tile):
        self.tile = tile
        self.parts: list[np.ndarray] = []
        self.edges: list[list[np.ndarray]] = []

    def outline(self) -> Outline:
        self.inside_at_spot = np.concatenate([np.empty(0, "i8"), *self.parts])
        if not self.edges:
            return NO_OUTLINE
        return outline_in(self.tile, Edges(*[np.concatenate(v) for v in zip(*self.edges)]), self.inside_at_spot)

    def cover(self) -> TileCover:
        outline = self.outline()
        return TileCover(self.tile, len(self.inside_at_spot) > 0, outline)


def _tiles(batches: Iterator[pa.RecordBatch], wide: float, high: float, spot: float, keys: list[str]) -> Iterator[tuple[TileRows, pa.RecordBatch | None]]:
    """Each tile once all its edges are there, first alone and then with each batch of its points."""
    rows, last, whole = None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        named = [batch.column(k).cast(pa.int64()).fill_null(NOWHERE).to_numpy(zero_copy_only=False) for k in (*keys, "kind")]
        starts = _starts(*named)
        for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
            *key, kind = (int(v[begin]) for v in named)
            if key != last:
                if rows and not whole:
                    yield rows, None
                rows, last, whole = TileRows(Tile(key[0], key[1], wide, high, spot)), key, False
            some = batch.slice(begin, end - begin)
            if kind == SPOT:
                rows.parts.append(some.column("number").to_numpy())
            elif kind == EDGE:
                rows.edges.append([some.column(c).to_numpy() for c in ("edge", "number", "x1", "y1", "x2", "y2")])
            else:
                if not whole:
                    yield rows, None
                    whole = True
                yield rows, some
    if rows and not whole:
        yield rows, None


def outlines(wide: float, high: float, spot: float, keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows in the order of their tiles: the pieces of each tile's outline."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _tiles(batches, wide, high, spot, keys):
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in rows.outline()], names=list(Outline._fields))

    return run


def points_inside(wide: float, high: float, spot: float, keys: list[str], name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows in the order of their tiles: the points, and whether each lies inside the outline."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = None
        for rows, points in _tiles(batches, wide, high, spot, keys):
            if points is None:
                cover = rows.cover()
                continue
            x, y = points.column("x1"), points.column("y1")
            unknown = ~(x.is_valid().to_numpy(zero_copy_only=False) & y.is_valid().to_numpy(zero_copy_only=False))
            x, y = (v.to_numpy(zero_copy_only=False) for v in (x, y))
            inside = np.zeros(len(x), bool)
            placed = np.flatnonzero(np.isfinite(x) & np.isfinite(y))
            inside[placed] = cover.holds(x[placed], y[placed])
            given = points.column("row")
            yield pa.RecordBatch.from_arrays([*given.flatten(), pa.array(inside, mask=unknown)], names=[*[f.name for f in given.type], name])

    return run
