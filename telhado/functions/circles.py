"""Text of circles drawn on the UTM plane: the code that runs in Python workers, on whole arrays of corners."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Sent along with the task, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Circles worked on at a time: their corners stay in a core's cache.
CHUNK = 256
# How near to a half of the last digit two ways of calculating may disagree on it; they differ by a hundredth of this.
DOUBT = 1e-6


def _multiples(s: np.ndarray, c: np.ndarray, sign: int, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sin, cos) of 1 to n times an angle (sign -1), or (sinh, cosh) (sign 1)."""
    out = [(s, c)]
    for _ in range(n - 1):
        s1, c1 = out[-1]
        out.append((s1 * c + c1 * s, c1 * c + sign * (s1 * s)))
    return out


def degrees_of(xi: np.ndarray, eta: np.ndarray, beta: tuple, series: tuple, meridian: float) -> tuple[np.ndarray, np.ndarray]:
    """Longitude and latitude of points given as angles of the transverse Mercator series."""
    turns = _multiples(np.sin(2 * xi), np.cos(2 * xi), -1, len(beta))
    rises = _multiples(np.sinh(2 * eta), np.cosh(2 * eta), 1, len(beta))
    xi = xi - sum(s * ch * b for (s, _), (_, ch), b in zip(turns, rises, beta))
    eta = eta - sum(c * sh * b for (_, c), (sh, _), b in zip(turns, rises, beta))
    chi = np.arcsin(np.sin(xi) / np.cosh(eta))
    lat = chi + sum(s * a for (s, _), a in zip(_multiples(np.sin(2 * chi), np.cos(2 * chi), -1, len(series)), series))
    return np.degrees(np.arctan2(np.sinh(eta), np.cos(xi))) + meridian, np.degrees(lat)


def circle_text(
    quarter: int, scale: float, east: float, north: float, beta: tuple, series: tuple, meridian: float, digits: int
) -> Callable[[pa.Array, pa.Array, pa.Array], pa.Array]:
    """Function of (easting, northing, radius) that gives the ring's text, "lon lat, lon lat, ...".

    It gives NULL for a circle it is not sure about: a coordinate that is missing, within DOUBT of a half of the last
    digit, a whole number, or one that is written with an exponent.
    """
    turns = [-2 * math.pi * i / (4 * quarter) for i in [*range(4 * quarter), 0]]
    cos, sin = (np.array([f(t) for t in turns]) for f in (math.cos, math.sin))
    unit = 10.0**digits

    def chunk(e: np.ndarray, n: np.ndarray, r: np.ndarray) -> pa.Array:
        xi = (n[:, None] + r[:, None] * sin - north) / scale
        eta = (e[:, None] + r[:, None] * cos - east) / scale
        texts, sure = [], np.ones(len(e), bool)
        for v in degrees_of(xi, eta, beta, series, meridian):
            raised = v * unit + 0.5
            whole = np.floor(raised)
            off = raised - whole
            value = whole / unit
            size = np.abs(value)
            # Comparisons with NaN are false, so it is never sure.
            good = (off > DOUBT) & (off < 1 - DOUBT) & (size >= 1e-3) & (size < 1e7) & (value != np.floor(value))
            sure &= good.all(axis=1)
            texts.append(pc.cast(pa.array(value.ravel()), pa.string()))
        corners = pc.binary_join_element_wise(*texts, " ")
        rings = pa.ListArray.from_arrays(pa.array(np.arange(0, len(corners) + 1, len(turns), dtype=np.int32)), corners)
        return pc.if_else(pa.array(sure), pc.binary_join(rings, ", "), pa.scalar(None, pa.string()))

    def text(easting: pa.Array, northing: pa.Array, radius: pa.Array) -> pa.Array:
        whole = [pc.fill_null(a.cast(pa.float64()), math.nan).to_numpy(zero_copy_only=False) for a in (easting, northing, radius)]
        with np.errstate(all="ignore"):
            parts = [chunk(*(a[i : i + CHUNK] for a in whole)) for i in range(0, len(easting), CHUNK)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return text


MEASURES = "sides bigint, closed boolean, " + ", ".join(
    f"{f}_{a} double" for a in ("easting", "northing", "longitude", "latitude") for f in ("low", "high")
) + ", doubled double"


def ring_measures(
    k: float, scale: float, east: float, north: float, alpha: tuple, meridian: float
) -> Callable[[pa.Array, pa.Array, pa.Array], pa.Array]:
    """Function of (text, easting, northing) that reads a ring's "lon lat, lon lat, ..." and gives its MEASURES.

    Boxes, in metres and degrees, are those of the corners that begin a side; twice the signed area is on the
    metric plane. Offsets from (easting, northing) keep its sums small.
    """

    def plane(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sin_lat = np.sin(np.radians(lat))
        t = np.sinh(np.arctanh(sin_lat) - k * np.arctanh(k * sin_lat))
        dlon = np.radians(lon - meridian)
        xi, eta = np.arctan2(t, np.cos(dlon)), np.arctanh(np.sin(dlon) / np.sqrt(t * t + 1))
        turns = _multiples(np.sin(2 * xi), np.cos(2 * xi), -1, len(alpha))
        rises = _multiples(np.sinh(2 * eta), np.cosh(2 * eta), 1, len(alpha))
        e = eta + sum(c * sh * a for (_, c), (sh, _), a in zip(turns, rises, alpha))
        n = xi + sum(s * ch * a for (s, _), (_, ch), a in zip(turns, rises, alpha))
        return e * scale + east, n * scale + north

    def chunk(rings: pa.Array, oe: np.ndarray, on: np.ndarray) -> pa.Array:
        corners = pc.split_pattern(rings, ", ")
        sizes = pc.list_value_length(corners).to_numpy()
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        last = first + sizes - 1
        pairs = pc.split_pattern(pc.list_flatten(corners), " ")
        lon, lat = (np.array(pc.cast(pc.list_element(pairs, i), pa.float64())) for i in (0, 1))
        closed = (lon[first] == lon[last]) & (lat[first] == lat[last])
        e, n = plane(lon, lat)
        de, dn = e - np.repeat(oe, sizes), n - np.repeat(on, sizes)
        doubled = de * np.roll(dn, -1) - np.roll(de, -1) * dn
        doubled[last] = 0.0
        out = [pa.array(sizes.astype(np.int64) - 1), pa.array(closed)]
        for v in (e, n, lon, lat):
            v[last] = v[first]
            out += [pa.array(f.reduceat(v, first)) for f in (np.minimum, np.maximum)]
        names = [part.split()[0] for part in MEASURES.split(", ")]
        return pa.StructArray.from_arrays([*out, pa.array(np.add.reduceat(doubled, first))], names)

    def measures(rings: pa.Array, easting: pa.Array, northing: pa.Array) -> pa.Array:
        oe, on = (a.to_numpy(zero_copy_only=False) for a in (easting, northing))
        return pa.concat_arrays(
            [chunk(rings[i : i + CHUNK], oe[i : i + CHUNK], on[i : i + CHUNK]) for i in range(0, len(rings), CHUNK)]
        )

    return measures
