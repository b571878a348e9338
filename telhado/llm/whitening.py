"""Whitening of quantised embeddings by refined eigenvectors.

The covariance is summed by tasks as exact integers. Its eigenvectors are first taken in single
precision and then corrected by the iteration of Ogita and Aishima: with R = I - X'X and S = X'AX a
correction E is read off entry by entry, and X + XE is twice as accurate, at the price of matrix
products in extended precision. Eigenvalues too close for that form a cluster; the matrix is
projected on the cluster, shifted, solved by itself, and the cluster's vectors are turned accordingly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telhado.session import materialise

from .common import arrow_map

SCALE = 256
COMPONENTS = 4
# Times that clusters are solved by themselves, and how deep clusters within clusters are.
TURNS = 6
# A variance below this part of the whole is rounding: nothing to whiten.
LEAST_VARIANCE = 1e-14
WIDE = np.longdouble
LONG = (1 << 63) - 1


def usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~F.coalesce(bad, F.lit(False))


def quantised(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of every entry, as a long; an entry too large for a long is an error."""

    def entry(c: Column) -> Column:
        x = F.floor(c.cast("double") * scale)
        return F.when(F.abs(c.cast("double") * scale) < 2.0**62, x).otherwise(F.raise_error(F.lit("an entry is too large")).cast("long"))

    return F.transform(embedding, entry)


def _correct(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One step: (corrected vectors, values, which pairs were too close, size of what was left to correct)."""
    r = np.eye(x.shape[1], dtype=WIDE) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    left = np.abs(s - np.diag(np.diag(s)))
    near = 2 * (np.sqrt((left**2).sum()) + np.sqrt((a**2).sum()) * np.sqrt((r**2).sum()))
    gap = values[None, :] - values[:, None]
    close = np.abs(gap) <= near
    e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
    far = max(float((left * ~close).max(initial=0)), float(np.abs(r).max(initial=0)))
    return x + x @ e, values, close, far


def _clusters(values: np.ndarray, close: np.ndarray) -> Iterator[np.ndarray]:
    """Groups of more than one value, each too close to the next."""
    order = np.argsort(values, kind="stable")
    group = [order[0]]
    for before, here in zip(order[:-1], order[1:]):
        if not close[before, here]:
            if len(group) > 1:
                yield np.array(group)
            group = []
        group.append(here)
    if len(group) > 1:
        yield np.array(group)


def eigenpairs(matrix: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit vectors in columns) of a symmetric matrix, in extended precision."""
    size = len(matrix)
    scale = np.abs(matrix).max(initial=0)
    if size == 0 or scale == 0:
        return np.zeros(size, WIDE), np.eye(size, dtype=WIDE)
    a = matrix.astype(WIDE) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    tolerance = 4 * size * float(np.finfo(WIDE).eps)
    for _ in range(TURNS):
        best = None
        while True:
            x, values, close, far = _correct(a, x)
            if far <= tolerance or best is not None and far > best / 4:
                break
            best = far
        turned = False
        for group in _clusters(values, close):
            own = x[:, group]
            inner = own.T @ (a @ own)
            inner = (inner + inner.T) / 2
            # Values equal to the last bit need no turning; else the shifted block is solved by itself.
            if np.abs(inner - np.diag(np.diag(inner))).max() > tolerance and depth < TURNS:
                centre = np.trace(inner) / len(group)
                x[:, group] = own @ eigenpairs(inner - centre * np.eye(len(group), dtype=WIDE), depth + 1)[1]
                turned = True
        if not turned:
            break
    # The values belong to the vectors as they are now.
    x, values, _, _ = _correct(a, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return values[order] * scale, x / np.sqrt((x**2).sum(axis=0))


@dataclass(frozen=True)
class Whitening:
    """Fitted on n vectors with sums per dimension: centre, directions (component, dimension), values, share of the variance."""

    n: int
    sums: list[int]
    centre: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) @ self.directions.T) / np.sqrt(self.values)


def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length, as rows of a matrix."""
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _summed(fit: DataFrame, partial, schema: str, keys: list[str], totals: list[str]) -> list:
    """Rows that each task makes of its vectors, added up by key: dimensions squared rows at most reach the driver."""
    return arrow_map(fit, partial, schema).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in totals)).collect()


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the different vectors `fit` (x); None if there is none, or no variance."""
    shape = fit.agg(
        F.count("*"), F.min(F.size("x")), F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x"))
    ).first()
    n, width, widest, low, high = shape
    if not n:
        return None
    if width != widest:
        raise ValueError(f"vectors of {width} and of {widest} entries")

    def column_sums(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        total = np.zeros(width, object)
        for batch in columns:
            x = _matrix(batch["x"])
            if len(x):
                # Halves add up without overflow.
                total += (x >> 20).sum(axis=0).astype(object) * (1 << 20) + (x & 0xFFFFF).sum(axis=0).astype(object)
        yield {"i": pa.array(np.arange(width), pa.int32()), "s": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))}

    sums = [0] * width
    for row in _summed(fit, column_sums, "i int, s decimal(38,0)", ["i"], ["s"]):
        sums[row["i"]] = int(row["s"])
    middle = np.array([round(s / n) if abs(s) < 1 << 50 else s // n for s in sums], np.int64)
    reach = max(high - int(middle.min()), int(middle.max()) - low, 1)
    # Whole products add up exactly in a float below 2^53 and in a long below 2^63.
    rows_at_once = max(1, (1 << 53) // reach**2)
    exact = reach < 1 << 26 and n * reach**2 < 1 << 62

    def products(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        total = np.zeros((width, width), np.int64 if exact else np.float64)
        for batch in columns:
            x = _matrix(batch["x"])
            for lo in range(0, len(x), rows_at_once):
                y = (x[lo : lo + rows_at_once] - middle).astype(np.float64)
                part = y.T @ y
                total += part.astype(np.int64) if exact else part
        i, j = np.triu_indices(width)
        yield {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "s": pa.array(total[i, j])}

    schema = f"i int, j int, s {'long' if exact else 'double'}"
    # The rest of the centre, n times: with it the covariance is exact.
    rest = [s - n * int(m) for s, m in zip(sums, middle)]
    covariance = np.zeros((width, width), WIDE)
    for row in _summed(fit, products, schema, ["i", "j"], ["s"]):
        i, j = row["i"], row["j"]
        if exact:
            value = WIDE(n * row["s"] - rest[i] * rest[j]) / WIDE(n) / WIDE(n)
        else:
            value = WIDE(row["s"]) / n - WIDE(rest[i]) / n * (WIDE(rest[j]) / n)
        covariance[i, j] = covariance[j, i] = value
    whole = np.trace(covariance)
    values, vectors = eigenpairs(covariance)
    kept = np.flatnonzero(values[:components] > whole * LEAST_VARIANCE)
    if not len(kept):
        return None
    directions = vectors[:, kept].T
    # Either sign is right; the largest entry is made positive.
    largest = directions[np.arange(len(kept)), np.abs(directions).argmax(axis=1)]
    directions = directions * np.where(largest < 0, -1, 1)[:, None]
    centre = np.array([WIDE(s) / n for s in sums], WIDE)
    return Whitening(
        n, sums, centre.astype(np.float64), directions.astype(np.float64),
        values[kept].astype(np.float64), (values[kept] / whole).astype(np.float64),
    )


def identity_error(fit: DataFrame, found: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    size = len(found.values)

    def partial(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        total = np.zeros((size, size + 1))
        for batch in columns:
            if len(batch["x"]):
                z = found.project(_matrix(batch["x"]))
                total += np.column_stack([z.T @ z, z.sum(axis=0)])
        i, j = np.divmod(np.arange(total.size), size + 1)
        yield {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "s": pa.array(total.ravel())}

    total = np.zeros((size, size + 1))
    for row in _summed(fit, partial, "i int, j int, s double", ["i", "j"], ["s"]):
        total[row["i"], row["j"]] = row["s"] / found.n
    # Projections are taken from the centre, so their mean is rounding and taking it off loses nothing.
    mean = total[:, size]
    return float(np.abs(total[:, :size] - np.outer(mean, mean) - np.eye(size)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Rows whose vector is null, empty, or holds a null or non-finite entry take no part; the fit counts
    every different quantised vector once, output has every remaining row, repeated ones and null ids
    too. `deviation` is a decimal(38,0). Components without variance are left out, so there are fewer
    than `components` where the vectors have fewer dimensions, and none for an empty table or
    equal vectors. Vectors of different lengths are an error; other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where(usable(F.col("embedding"))).select("vec_id", quantised(F.col("embedding"), scale).alias("x"))
    fit = materialise(rows.select("x").distinct(), "fit")
    found = fit_whitening(fit, components)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if found is None:
        return spark.createDataFrame([], schema)
    error, size = identity_error(fit, found), len(found.values)

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        for batch in columns:
            x = _matrix(batch["x"])
            count = len(x)
            if not count:
                continue
            reach = max(abs(found.n * int(v) - s) for v in (x.min(), x.max()) for s in (min(found.sums), max(found.sums)))
            if len(found.sums) * reach**2 <= LONG:
                deviation = ((found.n * x - np.array(found.sums, np.int64)) ** 2).sum(axis=1)
                deviation = pa.array(deviation, pa.int64()).cast(pa.decimal128(38, 0))
            else:
                wide = found.n * x.astype(object) - np.array(found.sums, object)
                deviation = pa.array([Decimal(int(d)) for d in (wide**2).sum(axis=1)], pa.decimal128(38, 0))
            at = pa.array(np.repeat(np.arange(count), size))
            yield {
                "vec_id": batch["vec_id"].take(at),
                "component": pa.array(np.tile(np.arange(1, size + 1), count), pa.int32()),
                "n": pa.array(np.full(count * size, found.n)),
                "deviation": deviation.take(at),
                "whitened": pa.array(found.project(x).ravel()),
                "explained": pa.array(np.tile(found.explained, count)),
                "identity_error": pa.array(np.full(count * size, error)),
            }

    return arrow_map(rows, run, schema)
