"""Projections as Column expressions over degrees and metres.

Formulas: spherical Mercator; transverse Mercator by Krueger's series in the third
flattening (order four); point scale of the transverse Mercator after Snyder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from . import circles

# Spherical Mercator radius; GRS80 ellipsoid; UTM scale and offsets.
SPHERE_RADIUS = 6378137.0
SEMI_MAJOR = 6378137.0
FLATTENING = 1.0 / 298.257222101
UTM_SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

E2 = FLATTENING * (2.0 - FLATTENING)
_N = FLATTENING / (2.0 - FLATTENING)
RECTIFYING_RADIUS = SEMI_MAJOR / (1.0 + _N) * (1.0 + _N**2 / 4.0 + _N**4 / 64.0)
# Conformal to geographic latitude, series of order four in e^2.
LATITUDE = (
    E2 / 2 + 5 * E2**2 / 24 + E2**3 / 12 + 13 * E2**4 / 360,
    7 * E2**2 / 48 + 29 * E2**3 / 240 + 811 * E2**4 / 11520,
    7 * E2**3 / 120 + 81 * E2**4 / 1120,
    4279 * E2**4 / 161280,
)
# Krueger coefficients of the forward (alpha) and inverse (beta) series.
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)


def central_meridian(zone: int) -> float:
    return zone * 6.0 - 183.0


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * SPHERE_RADIUS


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * SPHERE_RADIUS


def mercator_lon(x: Column) -> Column:
    return F.degrees(x / SPHERE_RADIUS)


def mercator_lat(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / SPHERE_RADIUS)) * 2 - F.lit(math.pi / 2))


def _sum(terms: list[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def utm_xy(lon: Column, lat: Column, zone: int = 24, south: bool = True) -> Column:
    """Struct (easting, northing) in metres."""
    k = 2 * math.sqrt(_N) / (1 + _N)
    sin_lat = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sin_lat) - F.atanh(sin_lat * k) * k)
    dlon = F.radians(lon - central_meridian(zone))
    xi = F.atan2(t, F.cos(dlon))
    eta = F.atanh(F.sin(dlon) / F.sqrt(t * t + 1))
    east = _sum([eta] + [F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a for j, a in enumerate(ALPHA, 1)])
    north = _sum([xi] + [F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a for j, a in enumerate(ALPHA, 1)])
    offset = FALSE_NORTHING_SOUTH if south else 0.0
    return F.struct(
        (east * (UTM_SCALE * RECTIFYING_RADIUS) + FALSE_EASTING).alias("easting"),
        (north * (UTM_SCALE * RECTIFYING_RADIUS) + offset).alias("northing"),
    )


def ring_measures(ring: Column, centre: Column, zone: int = 24, south: bool = True) -> Column:
    """Struct of `circles.MEASURES`: what the text of a ring around a `utm_xy` struct measures on the metric plane."""
    read = circles.ring_measures(
        2 * math.sqrt(_N) / (1 + _N), UTM_SCALE * RECTIFYING_RADIUS, FALSE_EASTING,
        FALSE_NORTHING_SOUTH if south else 0.0, ALPHA, central_meridian(zone),
    )
    return F.arrow_udf(read, circles.MEASURES)(ring, centre["easting"], centre["northing"])


def _utm_series_angles(easting: Column, northing: Column, south: bool) -> Column:
    scale = UTM_SCALE * RECTIFYING_RADIUS
    return F.struct(
        ((northing - (FALSE_NORTHING_SOUTH if south else 0.0)) / scale).alias("xi"),
        ((easting - FALSE_EASTING) / scale).alias("eta"),
    )


def _utm_undistorted(p: Column) -> Column:
    """Struct (xi, eta) with the ellipsoidal series taken off."""
    xi, eta = p["xi"], p["eta"]
    return F.struct(
        (xi - _sum([F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * b for j, b in enumerate(BETA, 1)])).alias("xi"),
        (eta - _sum([F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * b for j, b in enumerate(BETA, 1)])).alias("eta"),
    )


def _sphere_angles(p: Column) -> Column:
    """Struct (chi, lon): conformal latitude, and longitude from the central meridian, in radians."""
    return F.struct(
        F.asin(F.sin(p["xi"]) / F.cosh(p["eta"])).alias("chi"), F.atan2(F.sinh(p["eta"]), F.cos(p["xi"])).alias("lon")
    )


def _geographic(p: Column, zone: int) -> Column:
    chi = p["chi"]
    lat = chi + _sum([F.sin(chi * (2 * j)) * a for j, a in enumerate(LATITUDE, 1)])
    return F.struct(
        (F.degrees(p["lon"]) + central_meridian(zone)).alias("longitude"), F.degrees(lat).alias("latitude")
    )


def utm_lonlat(easting: Column, northing: Column, zone: int = 24, south: bool = True) -> Column:
    """Struct (longitude, latitude) in degrees: the inverse of `utm_xy`."""
    return _geographic(_sphere_angles(_utm_undistorted(_utm_series_angles(easting, northing, south))), zone)


def utm_point_scale(lon: Column, lat: Column, zone: int = 24) -> Column:
    """Length on the UTM plane of one metre on the ellipsoid, at a point."""
    ep2 = E2 / (1 - E2)
    cos = F.cos(F.radians(lat))
    t = F.pow(F.tan(F.radians(lat)), F.lit(2))
    c = cos * cos * ep2
    a2 = F.pow(F.radians(lon - central_meridian(zone)) * cos, F.lit(2))
    return (
        (c + 1) * a2 / 2 + (t * -4 + c * 42 + c * c * 13 + (5 - 28 * ep2)) * a2 * a2 / 24 + 1
    ) * UTM_SCALE


def mercator_reach(radius: Column, lon: Column, lat: Column, zone: int = 24) -> Column:
    """Half axes (x, y), on the Mercator plane, of a circle drawn on the UTM plane.

    The two differ by about half a percent: spherical Mercator, fed with ellipsoidal
    latitudes, stretches the two directions unequally.
    """
    sin2 = F.pow(F.sin(F.radians(lat)), F.lit(2))
    w = F.lit(1.0) - sin2 * E2
    ground = radius / utm_point_scale(lon, lat, zone) / F.cos(F.radians(lat))
    return F.struct(
        (ground * F.sqrt(w)).alias("x"),
        (ground * F.sqrt(w) * w / (1 - E2)).alias("y"),
    )


def coordinate_text(lon: Column, lat: Column, digits: int = 6) -> Column:
    """"lon lat" with at most `digits` decimals; arithmetic, since a format call per corner costs more than the corner."""
    unit = 10.0**digits
    lon, lat = (F.floor(v * unit + 0.5) / unit for v in (lon, lat))
    return F.concat_ws(" ", lon.cast("string"), lat.cast("string"))


def circle_ring(centre: Column, radius: Column, zone: int = 24, south: bool = True, quarter: int = 30) -> Column:
    """Closed clockwise ring of 4 x `quarter` corners in degrees: a circle drawn around a `utm_xy` struct.

    Each step of the way back to degrees is its own pass over the ring, so nothing is computed twice.
    """
    turns = [-2 * math.pi * i / (4 * quarter) for i in [*range(4 * quarter), 0]]
    circle = F.array(*[F.struct(F.lit(math.cos(t)).alias("c"), F.lit(math.sin(t)).alias("s")) for t in turns])
    ring = F.transform(
        circle,
        lambda t: _utm_series_angles(
            centre["easting"] + radius * t["c"], centre["northing"] + radius * t["s"], south
        ),
    )
    ring = F.transform(F.transform(ring, _utm_undistorted), _sphere_angles)
    return F.transform(ring, lambda p: _geographic(p, zone))


def spread_rows(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly to all tasks: for small rows with much work each, which a scan leaves to a few tasks."""
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks)


def with_buffer_wkt(
    points: DataFrame, radius: str = "dist_buffer", zone: int = 24, south: bool = True, quarter: int = 30
) -> DataFrame:
    """Add `buffer_wkt`: a circle of `radius` UTM metres as a closed ring of 4 x `quarter` points in degrees.

    Corners are worked out and written by the array; where that leaves a digit in doubt, one by one.
    """
    centred = spread_rows(points).withColumn("__centre", utm_xy(F.col("longitude"), F.col("latitude"), zone, south))
    by_array = F.arrow_udf(
        circles.circle_text(
            quarter, UTM_SCALE * RECTIFYING_RADIUS, FALSE_EASTING, FALSE_NORTHING_SOUTH if south else 0.0,
            BETA, LATITUDE, central_meridian(zone), digits=6,
        ),
        "string",
    )
    quick = centred.withColumn("__text", by_array("__centre.easting", "__centre.northing", F.col(radius).cast("double")))
    ring = circle_ring(F.col("__centre"), F.col(radius), zone, south, quarter)
    slow = F.array_join(F.transform(ring, lambda p: coordinate_text(p["longitude"], p["latitude"])), ", ")
    text = F.coalesce("__text", slow)
    return quick.withColumn("buffer_wkt", F.concat(F.lit("POLYGON (("), text, F.lit("))"))).drop("__centre", "__text")
