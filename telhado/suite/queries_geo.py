"""Queries over coordinates: postal codes, boundary, projections, hexagons."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geodesy, hexes, rings, text as tx
from ..operators import boundary, clean, geocode, hexgrid, hexjoin
from ..operators.joins import lookup_join
from ..plans import jobs
from ..session import materialise
from ..sources import landed
from .queries_ads import MUNIC_OUT, rounded, shown
from .registry import query
from .sql import E, H, R, ROOMS, S, cells_of, cep, edges, gold, grid, hex_join, mx, my, odd_crossings, polygon_join, reach, silver
from .views import Data

MEDIANS = "medians AS (SELECT cep, median(latitude) AS latitude, median(longitude) AS longitude FROM cep_points GROUP BY cep)"


def degrees(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in ("latitude", "longitude")})


def placed(d: Data) -> DataFrame:
    return clean.with_coordinates(d["ads"]).select("ad_id", "longitude", "latitude", "cep")


# Postal codes and geocoder answers


@query(
    "cep_median",
    f"WITH {MEDIANS} SELECT cep, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM medians",
    ("cep_points",),
)
def _(d: Data):
    return degrees(geocode.cep_medians(d["cep_points"]))


@query(
    "geocode_by_cep",
    f"WITH {MEDIANS} SELECT ad_id, a.cep, round(m.latitude, 6) AS latitude, round(m.longitude, 6) AS longitude "
    f"FROM ads a LEFT JOIN medians m ON m.cep = {cep('a.cep')}",
    ("ads", "cep_points"),
)
def _(d: Data):
    found = geocode.geocode_by_cep(d["ads"].select("ad_id", "cep"), geocode.cep_medians(d["cep_points"]), "ad_id")
    return degrees(found)


@query(
    "geocode_responses",
    "SELECT ad_id, url, round(CAST(body ->> '$.results[0].geometry.location.lat' AS DOUBLE), 6) AS latitude, "
    "round(CAST(body ->> '$.results[0].geometry.location.lng' AS DOUBLE), 6) AS longitude FROM geocoder_log "
    "WHERE body ->> '$.status' = 'OK' AND json_array_length(body, '$.results') > 0",
    ("geocoder_log",),
)
def _(d: Data):
    return degrees(landed.geocoder_points(d["geocoder_log"]))


# Boundary


@query(
    "boundary_latest_year",
    "SELECT year, ring, seq, coalesce(n, 0) AS n_ads_near FROM (SELECT year, ring, seq, floor(CAST(x AS DOUBLE) * 10) AS bx, floor(CAST(y AS DOUBLE) * 10) AS b_y "
    "FROM boundary WHERE year = (SELECT max(year) FROM boundary WHERE year BETWEEN 2000 AND 2026)) v "
    "LEFT JOIN (SELECT floor(longitude * 10) AS bx, floor(latitude * 10) AS b_y, count(*) AS n FROM ads GROUP BY 1, 2) a ON a.bx = v.bx AND a.b_y = v.b_y",
    ("boundary", "ads"),
)
def _(d: Data):
    """Vertices of the newest edition, with the ads in the same tenth-of-a-degree box."""

    def box(x, y):
        return [F.floor(F.col(x).cast("double") * 10).alias("bx"), F.floor(F.col(y).cast("double") * 10).alias("by")]

    newest = landed.latest_boundary(d["boundary"], 2026).select("year", "ring", "seq", *box("x", "y"))
    counted = placed(d).groupBy(*box("longitude", "latitude")).agg(F.count(F.lit(1)).alias("n_ads_near"))
    return newest.join(counted, ["bx", "by"], "left").fillna(0, ["n_ads_near"]).drop("bx", "by")


@query(
    "points_in_boundary",
    f"WITH {edges('eb', 2020, False)} SELECT ad_id, CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN "
    f"{odd_crossings('eb', 'a.longitude', 'a.latitude')} END AS inside FROM ads a",
    ("boundary", "ads"),
)
def _(d: Data):
    ads = d["ads"].select("ad_id", "longitude", "latitude")
    return boundary.points_in_boundary(ads, d.boundary_2020, ["ad_id"]).select("ad_id", "inside")


@query(
    "points_outside_boundary",
    f"WITH {edges('eb', 2020, False)} SELECT ad_id FROM ads a WHERE longitude IS NOT NULL AND latitude IS NOT NULL "
    f"AND NOT {odd_crossings('eb', 'a.longitude', 'a.latitude')}",
    ("boundary", "ads"),
)
def _(d: Data):
    ads = d["ads"].select("ad_id", "longitude", "latitude")
    return boundary.points_outside_boundary(ads, d.boundary_2020, ["ad_id"]).select("ad_id")


PART_EDGES = """
vs AS (SELECT part, ring, seq, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, count(*) OVER (PARTITION BY part, ring) AS n FROM boundary_parts),
eb AS (SELECT a.part, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
       FROM vs a JOIN vs b ON b.part = a.part AND b.ring = a.ring AND b.seq = (a.seq + 1) % a.n)
"""


@query(
    "points_in_union",
    f"WITH {PART_EDGES}, hit AS (SELECT ad_id, part FROM ads a JOIN eb e ON (e.y1 > a.latitude) <> (e.y2 > a.latitude) "
    "AND a.longitude < (e.x2 - e.x1) * (a.latitude - e.y1) / (e.y2 - e.y1) + e.x1 GROUP BY ad_id, part HAVING count(*) % 2 = 1) "
    "SELECT ad_id, CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN ad_id IN (SELECT ad_id FROM hit) END AS inside FROM ads",
    ("boundary_parts", "ads"),
    once=True,
)
def _(d: Data):
    """Ads inside any of many overlapping parts with holes and islands, by the outline of their union."""
    ads = d["ads"].select("ad_id", "longitude", "latitude")
    return boundary.points_in_boundary(ads, d["boundary_parts"], ["ad_id"]).select("ad_id", "inside")


@query(
    "coords_fallback",
    f"WITH {edges('eb', 2020, False)}, {MEDIANS}, "
    f"f AS (SELECT ad_id, cep, latitude, longitude, {odd_crossings('eb', 'a.longitude', 'a.latitude')} AS inside FROM ads a) "
    "SELECT ad_id, round(CASE WHEN NOT inside AND f.latitude IS NOT NULL THEN coalesce(m.latitude, f.latitude) ELSE f.latitude END, 6) AS latitude, "
    "round(CASE WHEN NOT inside AND f.latitude IS NOT NULL THEN coalesce(m.longitude, f.longitude) ELSE f.longitude END, 6) AS longitude "
    f"FROM f LEFT JOIN medians m ON m.cep = {cep('f.cep')}",
    ("boundary", "ads", "cep_points"),
)
def _(d: Data):
    ads = d["ads"].select("ad_id", "cep", "latitude", "longitude")
    medians = geocode.cep_medians(d["cep_points"])
    return degrees(geocode.coordinates_with_fallback(ads, medians, d.boundary_2020, "ad_id")).drop("cep")


# Projections


@query(
    "mercator_xy",
    f"SELECT ad_id, round({mx('longitude')}, 3) AS x, round({my('latitude')}, 3) AS y, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude "
    "FROM ads WHERE longitude IS NOT NULL AND latitude IS NOT NULL",
    ("ads",),
)
def _(d: Data):
    """To the plane and back."""
    flat = placed(d).select(
        "ad_id", geodesy.mercator_x(F.col("longitude")).alias("x"), geodesy.mercator_y(F.col("latitude")).alias("y")
    )
    return flat.select(
        "ad_id",
        F.round("x", 3).alias("x"),
        F.round("y", 3).alias("y"),
        F.round(geodesy.mercator_lon(F.col("x")), 6).alias("longitude"),
        F.round(geodesy.mercator_lat(F.col("y")), 6).alias("latitude"),
    )


def _utm_sql() -> str:
    """UTM by the older power series in longitude and latitude, unlike the query's own."""
    e2 = geodesy.E2
    ep2 = e2 / (1 - e2)
    arc = (
        f"6378137.0 * ({1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256 - 175 * e2**4 / 16384!r} * phi"
        f" - {3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024 + 105 * e2**4 / 4096!r} * sin(2 * phi)"
        f" + {15 * e2**2 / 256 + 45 * e2**3 / 1024 + 525 * e2**4 / 16384!r} * sin(4 * phi)"
        f" - {35 * e2**3 / 3072 + 175 * e2**4 / 12288!r} * sin(6 * phi) + {315 * e2**4 / 131072!r} * sin(8 * phi))"
    )
    return f"""
WITH p AS (SELECT ad_id, longitude, latitude, radians(latitude) AS phi, radians(longitude + 39.0) * cos(radians(latitude)) AS a
           FROM ads WHERE longitude IS NOT NULL AND latitude IS NOT NULL),
n AS (SELECT *, 6378137.0 / sqrt(1 - {e2!r} * pow(sin(phi), 2)) AS nu, pow(tan(phi), 2) AS t, {ep2!r} * pow(cos(phi), 2) AS c, {arc} AS m FROM p)
SELECT ad_id,
  round(500000.0 + 0.9996 * nu * (a + (1 - t + c) * pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * {ep2!r}) * pow(a, 5) / 120), 1) AS easting,
  round(10000000.0 + 0.9996 * (m + nu * tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * pow(a, 4) / 24
        + (61 - 58 * t + t * t + 600 * c - 330 * {ep2!r}) * pow(a, 6) / 720)), 1) AS northing,
  round(longitude, 6) AS longitude, round(latitude, 6) AS latitude
FROM n
"""


@query("utm_xy", _utm_sql(), ("ads",))
def _(d: Data):
    """To the metric plane and back."""
    flat = placed(d).select("ad_id", geodesy.utm_xy(F.col("longitude"), F.col("latitude")).alias("m"))
    back = geodesy.utm_lonlat(F.col("m.easting"), F.col("m.northing"))
    return degrees(
        flat.select(
            "ad_id",
            F.round("m.easting", 1).alias("easting"),
            F.round("m.northing", 1).alias("northing"),
            back["longitude"].alias("longitude"),
            back["latitude"].alias("latitude"),
        )
    )


@query("buffer_wkt")
def _(d: Data):
    ads = placed(d).withColumn("dist_buffer", tx.buffer_radius(F.col("cep")))
    return geodesy.with_buffer_wkt(ads).select("ad_id", "buffer_wkt")


def ring_texts(wkt) -> Column:
    """Rings of outline text, each the text of its points."""
    return F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))


def outline_points(wkt) -> Column:
    """Rings of outline text, each an array of (x, y) in degrees."""

    def point(text):
        pair = F.split(text, " ")
        return F.struct(pair[0].cast("double").alias("x"), pair[1].cast("double").alias("y"))

    return F.transform(ring_texts(wkt), lambda ring: F.transform(F.split(ring, ", "), point))


def ring_area(ring: Column, x0: Column, y0: Column) -> Column:
    """Signed area of a closed ring; offsets from (x0, y0) keep the sums small."""
    n = F.size(ring) - 1
    pairs = F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: (a["x"] - x0) * (b["y"] - y0) - (b["x"] - x0) * (a["y"] - y0),
    )
    return F.aggregate(pairs, F.lit(0.0), lambda t, v: t + v) / 2


def closed(rings_: Column) -> Column:
    return F.forall(rings_, lambda r: F.get(r, F.lit(0)) == F.element_at(r, -1))


@query(
    "buffer_outline",
    "SELECT ad_id, 121 AS n_points, TRUE AS closed, 2 * radius AS width_m, 2 * radius AS height_m, "
    "round(60 * sin(pi() / 60) * radius * radius / 1000) AS area_1000_m2, round(longitude, 3) AS longitude, round(latitude, 3) AS latitude "
    "FROM (SELECT *, CASE WHEN cep LIKE '%000' THEN 1000.0::DOUBLE ELSE 100.0::DOUBLE END AS radius FROM ads) "
    "WHERE longitude IS NOT NULL AND latitude IS NOT NULL",
    ("ads",),
)
def _(d: Data):
    """The circles' text read back: measures on the metric plane are those of a polygon of 120 corners."""
    ads = placed(d).withColumn("dist_buffer", tx.buffer_radius(F.col("cep")))
    text = geodesy.with_buffer_wkt(ads)
    centred = text.withColumn("o", geodesy.utm_xy(F.col("longitude"), F.col("latitude")))
    ring = centred.select("ad_id", "o", F.explode(ring_texts(F.col("buffer_wkt"))).alias("ring"))
    # A ring is one small row before the grouping: an ad listed twice has its rings measured together.
    measured = ring.select("ad_id", geodesy.ring_measures(F.col("ring"), F.col("o")).alias("m")).select("ad_id", "m.*")

    def middle(name: str) -> Column:
        return F.round((F.max(f"high_{name}") + F.min(f"low_{name}")) / 2, 3).alias(name)

    return measured.where("sides > 0").groupBy("ad_id").agg(
        (F.sum("sides") + 1).alias("n_points"),
        F.bool_and("closed").alias("closed"),
        F.round(F.max("high_easting") - F.min("low_easting"), 0).alias("width_m"),
        F.round(F.max("high_northing") - F.min("low_northing"), 0).alias("height_m"),
        F.round(F.abs(F.sum("doubled")) / 2000, 0).alias("area_1000_m2"),
        middle("longitude"),
        middle("latitude"),
    )


# Hexagons


@query("hex_of_point", f"WITH {cells_of('spots', 'c')} SELECT ad_id, q, r FROM c".replace(
    "WITH", "WITH spots AS (SELECT ad_id, longitude, latitude FROM ads WHERE longitude IS NOT NULL AND latitude IS NOT NULL),", 1),
    ("ads",),
)
def _(d: Data):
    return hexjoin.with_cell(placed(d)).select("ad_id", "q", "r")


HOME = (
    "spots AS (SELECT ad_id, longitude, latitude FROM ads WHERE longitude IS NOT NULL AND latitude IS NOT NULL),"
    f" {cells_of('spots', 'c')}, per_cell AS (SELECT q, r, count(*) AS n FROM c GROUP BY q, r)"
)


def built_grid(d: Data) -> DataFrame:
    return materialise(hexgrid.hex_grid(d.boundary_2020), "hex-grid")


def with_ad_count(d: Data, cells: DataFrame) -> DataFrame:
    # Joined on one struct: a struct is never NULL, so no test of it moves down into the cell arithmetic.
    cell = F.struct("q", "r").alias("cell")
    per_cell = hexjoin.with_cell(placed(d)).groupBy(cell).agg(F.count(F.lit(1)).alias("n_ads"))
    return cells.withColumn("cell", cell).join(per_cell, "cell", "left").fillna(0, ["n_ads"]).drop("cell")


@query(
    "hex_grid",
    f"WITH {grid()}, {HOME} SELECT hex_id, g.q::INTEGER AS q, g.r::INTEGER AS r, round(cx, 3) AS cx, round(cy, 3) AS cy, coalesce(n, 0) AS n_ads "
    "FROM grid g LEFT JOIN per_cell p ON p.q = g.q AND p.r = g.r",
    ("boundary", "ads"),
)
def _(d: Data):
    """The numbered grid, with the ads located in each cell."""
    cells = with_ad_count(d, built_grid(d))
    return cells.select("hex_id", "q", "r", F.round("cx", 3).alias("cx"), F.round("cy", 3).alias("cy"), "n_ads")


@query(
    "hex_cover",
    f"WITH {grid()}, {HOME} SELECT k.q::INTEGER AS q, k.r::INTEGER AS r, is_border, coalesce(n, 0) AS n_ads FROM kept k LEFT JOIN per_cell p ON p.q = k.q AND p.r = k.r",
    ("boundary", "ads"),
)
def _(d: Data):
    return with_ad_count(d, hexgrid.hex_cells(d.boundary_2020).select("q", "r", "is_border"))


@query(
    "hex_clip",
    f"WITH {grid()}, {HOME}, areas AS (SELECT p.q, p.r, sum((ax - cx) * (b_y - cy) - (bx - cx) * (ay - cy)) / 2 AS area FROM pieces p "
    "JOIN border b ON b.q = p.q AND b.r = p.r GROUP BY p.q, p.r) "
    "SELECT hex_id, round(a.area / 1000000, 4) AS area_km2, coalesce(n, 0) AS n_ads FROM grid g JOIN areas a ON a.q = g.q AND a.r = g.r "
    "LEFT JOIN per_cell p ON p.q = g.q AND p.r = g.r",
    ("boundary", "ads"),
)
def _(d: Data):
    """Border cells: area of the clipped rings, and the ads located in the cell."""
    cells = built_grid(d)
    border = cells.filter("is_border")
    drawn = border.select("hex_id", "outline").mapInPandas(
        rings.outline_rings, rings.POLYGONS
    )
    ring = F.flatten("polygons")

    def shoelace(points):
        pairs = F.zip_with(
            F.slice(points, F.lit(1), F.size(points) - 1),
            F.slice(points, F.lit(2), F.size(points) - 1),
            lambda a, b: (a["x"] - F.col("cx")) * (b["y"] - F.col("cy")) - (b["x"] - F.col("cx")) * (a["y"] - F.col("cy")),
        )
        return F.aggregate(pairs, F.lit(0.0), lambda t, v: t + v) / 2

    joined = with_ad_count(d, border).join(drawn, "hex_id")
    area = F.aggregate(F.transform(ring, shoelace), F.lit(0.0), lambda t, v: t + v)
    return joined.select("hex_id", F.round(area / 1e6, 4).alias("area_km2"), "n_ads")


SPOTS = """
src AS (SELECT ad_id AS id, ad_id, longitude, latitude, CASE WHEN cep LIKE '%000' THEN 1000.0 ELSE 100.0 END AS dist_buffer
        FROM ads WHERE longitude IS NOT NULL AND latitude IS NOT NULL)
"""


def joined_ads(d: Data, cells: DataFrame) -> DataFrame:
    ads = placed(d).withColumn("dist_buffer", tx.buffer_radius(F.col("cep"))).drop("cep")
    return hexjoin.hex_join(ads, cells, ["ad_id"], largest=tx.WIDE)


@query(
    "hex_join",
    f"WITH {grid()}, {SPOTS}, {hex_join('src', 's.ad_id')} SELECT ad_id, hex_id FROM hexed",
    ("boundary", "ads"),
)
def _(d: Data):
    return joined_ads(d, built_grid(d)).select("ad_id", "hex_id")


@query(
    "hex_lookup",
    f"WITH {grid()}, {SPOTS}, {hex_join('src', 's.ad_id')} SELECT ad_id, h.hex_id, round(g.cx, 3) AS cx, round(g.cy, 3) AS cy "
    "FROM hexed h LEFT JOIN grid g ON g.hex_id = h.hex_id",
    ("boundary", "ads"),
)
def _(d: Data):
    """Each assigned ad takes its hexagon's centre by number."""
    cells = built_grid(d)
    table = cells.select("hex_id", F.round("cx", 3).alias("cx"), F.round("cy", 3).alias("cy"))
    return lookup_join(joined_ads(d, cells).select("ad_id", "hex_id"), table, ["hex_id"], ["ad_id"], hot_only=True)


# Each ad's circle laid from outside against a side of the ad's own hexagon: by less than a metre it
# reaches over the side or falls short, beside the side's ends too.
AGAINST_SIDES = f"""
{cells_of('src', 'own')},
laid AS (SELECT *, {reach()[0]} AS rx, {reach()[1]} AS ry, (ad_id % 6) * pi() / 3 AS turn,
    ((ad_id * 37) % 1000 / 1000.0 - 0.5) * CAST({1.2 * E} AS DOUBLE) AS along, (ad_id * 61) % 2000 / 1000.0 - 0.9995 AS gap FROM own),
pushed AS (SELECT *, {S / 2} + gap + sqrt(pow(rx * cos(turn), 2) + pow(ry * sin(turn), 2)) AS away FROM laid),
against AS (SELECT id, ad_id, dist_buffer,
    degrees((CAST({S} AS DOUBLE) * (q + r / 2.0) + away * cos(turn) - along * sin(turn)) / {R}) AS longitude,
    degrees(2 * atan(exp((CAST({1.5 * E} AS DOUBLE) * r + away * sin(turn) + along * cos(turn)) / {R})) - pi() / 2) AS latitude FROM pushed)
"""


@query(
    "hex_join_polygon",
    f"WITH {grid()}, {SPOTS}, {AGAINST_SIDES}, {polygon_join('against')} "
    "SELECT a.ad_id, t.hex_id FROM against a LEFT JOIN touch t ON t.id = a.id",
    ("boundary", "ads"),
)
def _(d: Data):
    """Circles within a metre of hexagon sides: their polygons of 120 corners decide."""
    ads = hexjoin.with_cell(placed(d)).withColumn("dist_buffer", tx.buffer_radius(F.col("cep")))
    axes = geodesy.mercator_reach(F.col("dist_buffer"), F.col("longitude"), F.col("latitude"))
    laid = ads.select(
        "ad_id", "dist_buffer", "q", "r", axes.alias("axes"),
        ((F.col("ad_id") % 6) * (math.pi / 3)).alias("turn"),
        (((F.col("ad_id") * 37) % 1000 / 1000 - 0.5) * (1.2 * E)).alias("along"),
        ((F.col("ad_id") * 61) % 2000 / 1000 - 0.9995).alias("gap"),
    )
    cos, sin, along = F.cos("turn"), F.sin("turn"), F.col("along")
    away = F.hypot(F.col("axes.x") * cos, F.col("axes.y") * sin) + F.col("gap") + S / 2
    against = laid.select(
        "ad_id", "dist_buffer",
        geodesy.mercator_lon(hexes.centre_x(F.col("q"), F.col("r")) + away * cos - along * sin).alias("longitude"),
        geodesy.mercator_lat(hexes.centre_y(F.col("r")) + away * sin + along * cos).alias("latitude"),
    )
    joined = hexjoin.hex_join(against, built_grid(d), ["ad_id"], largest=tx.WIDE, quarter=30)
    return joined.select("ad_id", "hex_id")


@query("hex_wkt")
def _(d: Data):
    """Outlines of the hexagons that ads touch, with the number of ads that do."""
    cells = built_grid(d)
    counted = joined_ads(d, cells).groupBy("hex_id").agg(F.count(F.lit(1)).alias("n_ads"))
    return counted.join(hexgrid.hex_wkt(cells), "hex_id", "left")


# Area, and centre of the box around it, of each hexagon's part inside the boundary.
OUTLINES = f"""
inside_parts AS (
  SELECT p.q, p.r, round(sum((ax - cx) * (b_y - cy) - (bx - cx) * (ay - cy)) / 2000000, 4) AS area_km2,
    round((min(least(ax, bx)) + max(greatest(ax, bx))) / 2, 0) AS x, round((min(least(ay, b_y)) + max(greatest(ay, b_y))) / 2, 0) AS y
  FROM pieces p JOIN border b ON b.q = p.q AND b.r = p.r GROUP BY p.q, p.r),
outlines AS (
  SELECT hex_id, TRUE AS closed, CASE WHEN is_border THEN area_km2 ELSE round({S} * {S} * {H} / 1000000, 4) END AS area_km2,
    CASE WHEN is_border THEN x ELSE round(cx, 0) END AS x, CASE WHEN is_border THEN y ELSE round(cy, 0) END AS y
  FROM grid g LEFT JOIN inside_parts i ON i.q = g.q AND i.r = g.r)
"""
DIGITS = 12


def with_outline_measures(df: DataFrame) -> DataFrame:
    """Replace the outline's text by what can be read back from it: closed, area_km2, x, y."""
    flat = F.transform(
        outline_points(F.col("geometry_wkt")),
        lambda ring: F.transform(
            ring,
            lambda p: F.struct(geodesy.mercator_x(p["x"]).alias("x"), geodesy.mercator_y(p["y"]).alias("y")),
        ),
    )
    first = F.col("flat")[0][0]
    area = F.aggregate(
        F.transform("flat", lambda ring: ring_area(ring, first["x"], first["y"])), F.lit(0.0), lambda t, v: t + v
    )

    def middle(axis):
        values = F.transform(F.flatten("flat"), lambda p: p[axis])
        return F.round((F.array_max(values) + F.array_min(values)) / 2, 0)

    return df.withColumn("flat", flat).withColumns(
        {
            "closed": closed(F.col("flat")), "area_km2": F.round(area / 1e6, 4), "x": middle("x"), "y": middle("y"),
        }
    ).drop("flat", "geometry_wkt")


@query(
    "hex_outline",
    f"WITH {grid()}, {SPOTS}, {hex_join('src', 's.ad_id')}, {OUTLINES} SELECT h.hex_id, count(*) AS n_ads, any_value(closed) AS closed, "
    "any_value(area_km2) AS area_km2, any_value(x) AS x, any_value(y) AS y FROM hexed h LEFT JOIN outlines o ON o.hex_id = h.hex_id GROUP BY h.hex_id",
    ("boundary", "ads"),
)
def _(d: Data):
    """The outlines' text of hexagons that ads touch, read back; the number of ads that touch each."""
    cells = built_grid(d)
    counted = joined_ads(d, cells).groupBy("hex_id").agg(F.count(F.lit(1)).alias("n_ads"))
    return with_outline_measures(counted.join(hexgrid.hex_wkt(cells, digits=DIGITS), "hex_id", "left"))


# Layers


BRONZE_HEX = f"""
WITH {MEDIANS},
raw AS (SELECT url, titulos, cep FROM ads_curr WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY titulos, cep) = 1),
old AS (SELECT url, bool_or(latitude IS NULL OR longitude IS NULL) AS lacking, first(latitude ORDER BY latitude NULLS FIRST) AS latitude,
          first(longitude ORDER BY latitude NULLS FIRST) AS longitude FROM ads_prev WHERE url IS NOT NULL AND url <> '' GROUP BY url)
SELECT r.url, r.titulos, r.cep,
  round(CASE WHEN o.url IS NULL OR o.lacking THEN m.latitude ELSE o.latitude END, 6) AS latitude,
  round(CASE WHEN o.url IS NULL OR o.lacking THEN m.longitude ELSE o.longitude END, 6) AS longitude
FROM raw r LEFT JOIN old o ON o.url = r.url LEFT JOIN medians m ON m.cep = {cep('r.cep')}
"""


@query("bronze_hex", BRONZE_HEX, ("ads_prev", "ads_curr", "cep_points"))
def _(d: Data):
    out = jobs.bronze_hexagonal(
        d["ads_curr"].select("url", "titulos", "cep"), d["ads_prev"], geocode.cep_medians(d["cep_points"])
    )
    return degrees(out)


BRONZE_HEX_ANSWERS = f"""
WITH {MEDIANS}, {edges('eb', 2020, False)},
raw AS (SELECT url, titulos, cep FROM ads_curr WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY titulos, cep) = 1),
old AS (SELECT url, bool_or(latitude IS NULL OR longitude IS NULL) AS lacking, first(latitude ORDER BY latitude NULLS FIRST) AS latitude,
          first(longitude ORDER BY latitude NULLS FIRST) AS longitude FROM ads_prev WHERE url IS NOT NULL AND url <> '' GROUP BY url),
pts AS (SELECT url, CAST(body ->> '$.results[0].geometry.location.lat' AS DOUBLE) AS lat, CAST(body ->> '$.results[0].geometry.location.lng' AS DOUBLE) AS lon
        FROM geocoder_log WHERE body ->> '$.status' = 'OK' AND json_array_length(body, '$.results') > 0),
flagged AS (SELECT *, {odd_crossings('eb', 'pts.lon', 'pts.lat')} AS inside FROM pts),
joined AS (SELECT r.url, r.titulos, r.cep, o.url IS NULL OR o.lacking AS pending, o.latitude AS olat, o.longitude AS olon,
             m.latitude AS mlat, m.longitude AS mlon, f.lat, f.lon, f.inside
           FROM raw r LEFT JOIN old o ON o.url = r.url LEFT JOIN medians m ON m.cep = {cep('r.cep')} LEFT JOIN flagged f ON f.url = r.url)
SELECT url, titulos, cep,
  round(CASE WHEN NOT pending THEN olat WHEN inside THEN lat ELSE coalesce(mlat, lat) END, 6) AS latitude,
  round(CASE WHEN NOT pending THEN olon WHEN inside THEN lon ELSE coalesce(mlon, lon) END, 6) AS longitude
FROM joined
"""


@query("bronze_hex_answers", BRONZE_HEX_ANSWERS, ("ads_prev", "ads_curr", "cep_points", "geocoder_log", "boundary"))
def _(d: Data):
    """A geocoder's answers first, postal codes where the answer lies outside the boundary."""
    out = jobs.bronze_hexagonal(
        d["ads_curr"].select("url", "titulos", "cep"),
        d["ads_prev"],
        geocode.cep_medians(d["cep_points"]),
        answers=landed.geocoder_points(d["geocoder_log"]),
        vertices=d.boundary_2020,
    )
    return degrees(out)


SILVER_HEX = f"""
WITH {silver(coords=True)}, {grid()},
src AS (SELECT row_number() OVER () AS id, *, CASE WHEN cep LIKE '%000' THEN 1000.0::DOUBLE ELSE 100.0::DOUBLE END AS dist_buffer FROM silver),
{hex_join('src', ', '.join(f's.{c.strip()}' for c in MUNIC_OUT.split(',')) + ', s.dist_buffer')}
"""


@query("silver_hex", f"{SILVER_HEX} SELECT * FROM hexed", ("boundary", "ads"))
def _(d: Data):
    return shown(jobs.silver_hexagonal(d.bronze(), built_grid(d)))


@query("silver_hex_wkt")
def _(d: Data):
    """Silver rows with the outline of their hexagon."""
    cells = built_grid(d)
    return shown(jobs.silver_hexagonal(d.bronze(), cells, materialise(hexgrid.hex_wkt(cells), "hex-wkt")))


@query(
    "silver_hex_outline",
    f"{SILVER_HEX}, {OUTLINES} SELECT h.*, closed, area_km2, x, y FROM hexed h LEFT JOIN outlines o ON o.hex_id = h.hex_id",
    ("boundary", "ads"),
)
def _(d: Data):
    """Silver rows whose hexagon's outline is read back from its text."""
    cells = built_grid(d)
    wkt = materialise(hexgrid.hex_wkt(cells, digits=DIGITS), "hex-wkt")
    return with_outline_measures(shown(jobs.silver_hexagonal(d.bronze(), cells, wkt)))


@query("indicators_hex", f"{SILVER_HEX}, {gold('hex_id', 'hexed')}", ("boundary", "ads"))
def _(d: Data):
    return rounded(jobs.gold(jobs.silver_hexagonal(d.bronze(), built_grid(d)), "hex_id", ROOMS))


@query("indicators_hex_found_labels", f"{SILVER_HEX}, {gold('hex_id', 'hexed')}", ("boundary", "ads"))
def _(d: Data):
    """Room labels read from the data, as when the caller names none."""
    return rounded(jobs.gold(jobs.silver_hexagonal(d.bronze(), built_grid(d)), "hex_id"))
