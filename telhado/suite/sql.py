"""SQL fragments shared by the counterparts."""

from __future__ import annotations

import math

from ..functions import geodesy

NUMBER = r"^[^0-9.-]*(-?,*(?:[0-9][0-9,]*(?:\.[0-9,]*)?|\.,*[0-9][0-9,]*)(?:[eE][+-]?[0-9]+)?)"


def number(c: str) -> str:
    return f"TRY_CAST(replace(regexp_extract({c}, '{NUMBER}', 1), ',', '') AS DOUBLE)"


def label(c: str) -> str:
    return (
        f"concat(CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END,"
        f" '_', CASE WHEN {c} = 1 THEN 'quarto' ELSE 'quartos' END)"
    )


def cep(c: str) -> str:
    digits = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    padded = f"lpad({digits}, 8, '0')"
    return (
        f"CASE WHEN length({digits}) BETWEEN 1 AND 8 THEN concat(substr({padded}, 1, 5), '-', substr({padded}, 6, 3)) END"
    )


TEXT_COLUMNS = "endereco, bairro, municipio, cep, UF"


def silver(source: str = "ads", coords: bool = False) -> str:
    """CTEs `typed`, `one_each` (duplicates removed) and `silver` (valid rows only)."""
    place = ", latitude, longitude" if coords else ""
    keys = f"titulos, preco, area_m2, n_quartos, n_banheiros, n_vagas_garagem, {TEXT_COLUMNS}{place}"
    also = " AND latitude IS NOT NULL AND longitude IS NOT NULL" if coords else ""
    return f"""
typed AS (
  SELECT url, titulos, {number('preco_txt')} AS p0, {number('area_m2')} AS area_m2,
    nullif({number('n_quartos')}, 0) AS n_quartos, nullif({number('n_banheiros')}, 0) AS n_banheiros,
    nullif({number('n_vagas_garagem')}, 0) AS n_vagas_garagem, {TEXT_COLUMNS}{place}
  FROM {source}),
repaired AS (SELECT * EXCLUDE (p0), CASE WHEN p0 < 10000 THEN p0 * 1000 ELSE p0 END AS preco FROM typed),
one_each AS (SELECT min(url) AS url, {keys} FROM repaired GROUP BY {keys}),
silver AS (SELECT * FROM one_each WHERE preco IS NOT NULL AND preco <> 0 AND preco < 100000000{also})
"""


ROOMS = ["1_quarto", "2_quartos", "3_quartos", "4_quartos", "5_quartos"]


def cents(x: str) -> str:
    """Half up at two decimals by plain arithmetic, the same in both engines even at ties."""
    return f"floor(({x}) * 100 + 0.5) / 100"


def gold(key: str, source: str) -> str:
    """Indicators put together from three aggregates, NULL keys matching NULL."""
    rooms = ", ".join(f"""max(CASE WHEN q = '{r}' THEN {cents('m')} END) AS "{r}" """ for r in ROOMS)
    picks = ", ".join(f'r."{r}"' for r in ROOMS)
    return f"""
stats AS (SELECT {key} AS k, max(preco) AS preco_max, min(preco) AS preco_min, {cents('avg(preco)')} AS preco_med
          FROM {source} GROUP BY {key}),
area AS (SELECT {key} AS k, round_even(sum(preco) / sum(area_m2), 1) AS preco_medio_area
         FROM {source} WHERE preco IS NOT NULL AND area_m2 > 10 GROUP BY {key}),
by_rooms AS (SELECT {label('n_quartos')} AS q, {key} AS k, avg(preco) AS m
             FROM {source} WHERE n_quartos IS NOT NULL GROUP BY 1, 2),
rooms AS (SELECT k, {rooms} FROM by_rooms GROUP BY k)
SELECT s.k AS {key}, preco_max, preco_min, preco_med, preco_medio_area, {picks}
FROM stats s LEFT JOIN area a ON a.k IS NOT DISTINCT FROM s.k LEFT JOIN rooms r ON r.k IS NOT DISTINCT FROM s.k
"""


# Spherical Mercator and the grid of 5,000 m hexagons.
R = 6378137.0
S = 5000.0
E = S / math.sqrt(3.0)
H = math.sqrt(3.0) / 2
E2 = (1 / 298.257222101) * (2 - 1 / 298.257222101)


def mx(lon: str) -> str:
    return f"(radians({lon}) * {R})"


def my(lat: str) -> str:
    return f"(ln(tan({math.pi / 4} + radians({lat}) / 2)) * {R})"


def cells_of(source: str, out: str) -> str:
    """CTE `out`: rows of `source` with mx, my and cell q, r, by cube rounding."""
    return f"""
{out}_m AS (SELECT *, {mx('longitude')} AS mx, {my('latitude')} AS my FROM {source}),
{out}_f AS (SELECT *, my / {1.5 * E} AS rf, mx / {S} - my / {3 * E} AS qf FROM {out}_m),
{out}_r AS (SELECT *, floor(qf + 0.5) AS q0, floor(rf + 0.5) AS r0, floor(-qf - rf + 0.5) AS s0 FROM {out}_f),
{out}_d AS (SELECT *, abs(q0 - qf) AS dq, abs(r0 - rf) AS dr, abs(s0 + qf + rf) AS ds FROM {out}_r),
{out} AS (SELECT * EXCLUDE (rf, qf, q0, r0, s0, dq, dr, ds),
    CAST(CASE WHEN dq > dr AND dq > ds THEN -r0 - s0 ELSE q0 END AS INTEGER) AS q,
    CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -q0 - s0 ELSE r0 END AS INTEGER) AS r
  FROM {out}_d)
"""


def edges(name: str, year: int, metres: bool) -> str:
    """CTE `name`: directed boundary edges of one edition."""
    x, y = ("CAST(x AS DOUBLE)", "CAST(y AS DOUBLE)")
    if metres:
        x, y = mx(x), my(y)
    return f"""
{name}_v AS (SELECT ring, seq, {x} AS x, {y} AS y, count(*) OVER (PARTITION BY ring) AS n
             FROM boundary WHERE year = {year}),
{name} AS (SELECT a.ring, a.seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
           FROM {name}_v a JOIN {name}_v b ON b.ring = a.ring AND b.seq = (a.seq + 1) % a.n)
"""


def odd_crossings(edge: str, x: str, y: str) -> str:
    """Scalar: is the point inside, counted over all rows of the edge CTE."""
    return (
        f"(SELECT count(*) % 2 = 1 FROM {edge} e WHERE (e.y1 > {y}) <> (e.y2 > {y})"
        f" AND {x} < (e.x2 - e.x1) * ({y} - e.y1) / (e.y2 - e.y1) + e.x1)"
    )


def _clip() -> str:
    lows, highs = ["0.0"], ["1.0"]
    for nx, ny in ((1.0, 0.0), (0.5, H), (-0.5, H)):
        start = f"((x1 - cx) * {nx} + (y1 - cy) * {ny})"
        rate = f"((x2 - x1) * {nx} + (y2 - y1) * {ny})"
        a, b = f"((-{S / 2} - {start}) / {rate})", f"(({S / 2} - {start}) / {rate})"
        lows.append(f"least({a}, {b})")
        highs.append(f"greatest({a}, {b})")
    return f"greatest({', '.join(lows)}) AS t0, least({', '.join(highs)}) AS t1"


def grid(year: int = 2020) -> str:
    """CTEs of the hexagon grid: `pieces` (outline of border cells) and `grid` (numbered cells).

    Every cell of the box meets every edge, and cell sides are cut at their crossings with the
    edges themselves, so the enumeration does not lean on that of the query.
    """
    spots = [(S / 2, -E / 2), (S / 2, E / 2), (0.0, E), (-S / 2, E / 2), (-S / 2, -E / 2), (0.0, -E)]
    sides = ", ".join(
        f"({a[0]!r}::DOUBLE, {a[1]!r}::DOUBLE, {b[0]!r}::DOUBLE, {b[1]!r}::DOUBLE)" for a, b in zip(spots, spots[1:] + spots[:1])
    )
    return f"""
{edges('em', year, True)},
box AS (SELECT min(x1) AS x0, max(x1) AS x9, min(y1) AS y0, max(y1) AS y9 FROM em),
rows_ AS (SELECT unnest(range(CAST(floor(y0 / {1.5 * E}) AS BIGINT) - 1, CAST(ceil(y9 / {1.5 * E}) AS BIGINT) + 2)) AS r, x0, x9 FROM box),
all_cells AS (SELECT q, r, CAST({S} AS DOUBLE) * (q + r / 2.0) AS cx, CAST({1.5 * E} AS DOUBLE) * r AS cy FROM (
  SELECT r, unnest(range(CAST(floor(x0 / {S} - r / 2.0) AS BIGINT) - 1, CAST(ceil(x9 / {S} - r / 2.0) AS BIGINT) + 2)) AS q FROM rows_)),
cuts AS (SELECT q, r, cx, cy, x1, y1, x2, y2, {_clip()} FROM all_cells, em),
drawn AS (SELECT q, r, cx, cy, x1 + (x2 - x1) * t0 AS ax, y1 + (y2 - y1) * t0 AS ay, x1 + (x2 - x1) * t1 AS bx,
            y1 + (y2 - y1) * t1 AS b_y FROM cuts WHERE t0 <= t1),
border AS (SELECT DISTINCT q, r, cx, cy FROM drawn),
sides AS (SELECT q, r, cx + s.a AS sx, cy + s.b AS sy, cx + s.c AS ex, cy + s.d AS ey
          FROM border, (VALUES {sides}) AS s(a, b, c, d)),
side_hits AS (
  SELECT q, r, sx, sy, ex, ey, ((x1 - sx) * (y2 - y1) - (y1 - sy) * (x2 - x1)) / ((ex - sx) * (y2 - y1) - (ey - sy) * (x2 - x1)) AS t,
    ((x1 - sx) * (ey - sy) - (y1 - sy) * (ex - sx)) / ((ex - sx) * (y2 - y1) - (ey - sy) * (x2 - x1)) AS u
  FROM sides, em),
side_cuts AS (SELECT q, r, sx, sy, ex, ey,
    list_sort(list_concat([0.0::DOUBLE, 1.0::DOUBLE], coalesce(list(t) FILTER (WHERE t > 0 AND t < 1 AND u >= 0 AND u <= 1), []))) AS ts
  FROM side_hits GROUP BY q, r, sx, sy, ex, ey),
side_spans AS (SELECT *, unnest(range(1, len(ts))) AS i FROM side_cuts),
side_parts AS (SELECT q, r, sx + (ex - sx) * ts[i] AS ax, sy + (ey - sy) * ts[i] AS ay,
                 sx + (ex - sx) * ts[i + 1] AS bx, sy + (ey - sy) * ts[i + 1] AS b_y FROM side_spans),
pieces AS (
  SELECT q, r, ax, ay, bx, b_y FROM drawn
  UNION ALL
  SELECT q, r, ax, ay, bx, b_y FROM side_parts WHERE {odd_crossings('em', '(ax + bx) / 2', '(ay + b_y) / 2')}),
kept AS (
  SELECT q, r, cx, cy, TRUE AS is_border FROM border
  UNION ALL
  SELECT q, r, cx, cy, FALSE FROM all_cells c
  WHERE NOT EXISTS (SELECT 1 FROM border b WHERE b.q = c.q AND b.r = c.r) AND {odd_crossings('em', 'c.cx', 'c.cy')}),
grid AS (SELECT CAST(row_number() OVER (ORDER BY r, q) AS INTEGER) AS hex_id, * FROM kept)
"""


def _segment2(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> str:
    w2 = f"(({bx} - {ax}) * ({bx} - {ax}) + ({by} - {ay}) * ({by} - {ay}))"
    t = f"greatest(0.0, least(1.0, coalesce((({px} - {ax}) * ({bx} - {ax}) + ({py} - {ay}) * ({by} - {ay})) / nullif({w2}, 0), 0.0)))"
    return (
        f"(pow({px} - {ax} - {t} * ({bx} - {ax}), 2) + pow({py} - {ay} - {t} * ({by} - {ay}), 2))"
    )


def reach() -> tuple[str, str]:
    """Half axes on the map of a circle of `dist_buffer` UTM metres around `longitude`, `latitude`."""
    ep2 = E2 / (1 - E2)
    cos = "cos(radians(latitude))"
    a2 = f"pow(radians(longitude + 39.0) * {cos}, 2)"
    c = f"({cos} * {cos} * {ep2!r})"
    t = "pow(tan(radians(latitude)), 2)"
    k = f"(0.9996 * (1 + (1 + {c}) * {a2} / 2 + (5 - 4 * {t} + 42 * {c} + 13 * {c} * {c} - 28 * {ep2!r}) * {a2} * {a2} / 24))"
    w = f"(1 - {E2!r} * pow(sin(radians(latitude)), 2))"
    return f"dist_buffer / {k} / {cos} * sqrt({w})", f"dist_buffer / {k} / {cos} * pow({w}, 1.5) / (1 - {E2!r})"


def hex_join(source: str, columns: str) -> str:
    """CTEs after `grid`: `touch` (id, hex_id) for rows of `source`, and `hexed`: `columns` and hex_id.

    `source` needs id, longitude, latitude and dist_buffer.
    """
    rx, ry = reach()
    return f"""
{cells_of(source, 'spot')},
reach AS (SELECT *, {rx} AS rx, {ry} AS ry FROM spot),
around AS (SELECT a.*, g.hex_id, g.q AS gq, g.r AS gr, g.is_border, abs(a.mx - g.cx) AS u, abs(a.my - g.cy) AS v
  FROM reach a JOIN (VALUES (0,0),(1,0),(-1,0),(0,1),(0,-1),(1,-1),(-1,1)) AS o(a, b) ON TRUE
  JOIN grid g ON g.q = a.q + o.a AND g.r = a.r + o.b),
close_ AS (SELECT *, rx / ry AS f FROM around),
near AS (SELECT * FROM close_ WHERE (u <= {S / 2} AND u / 2 + v * {H} <= {S / 2})
   OR least({_segment2('u', 'v * f', str(S / 2), '0.0', str(S / 2), f'f * {E / 2}')},
            {_segment2('u', 'v * f', str(S / 2), f'f * {E / 2}', '0.0', f'f * {E}')}) <= rx * rx),
border_touch AS (
  SELECT n.id, n.hex_id,
    min({_segment2('0.0', '0.0', '(p.ax - n.mx)', '((p.ay - n.my) * n.f)', '(p.bx - n.mx)', '((p.b_y - n.my) * n.f)')}) AS d2,
    any_value(n.rx) AS rx,
    count(*) FILTER (WHERE (p.ay > n.my) <> (p.b_y > n.my)
      AND n.mx < (p.bx - p.ax) * (n.my - p.ay) / (p.b_y - p.ay) + p.ax) AS crossings
  FROM near n JOIN pieces p ON p.q = n.gq AND p.r = n.gr WHERE n.is_border GROUP BY n.id, n.hex_id),
touch AS (SELECT id, hex_id FROM near WHERE NOT is_border
  UNION ALL SELECT id, hex_id FROM border_touch WHERE d2 <= rx * rx OR crossings % 2 = 1),
hexed AS (SELECT {columns}, t.hex_id FROM {source} s LEFT JOIN touch t ON t.id = s.id)
"""


def _turned(terms: tuple[float, ...], sign: str, xi: str, eta: str, outer: str, inner: str) -> str:
    return xi + "".join(f" {sign} {c!r} * {outer}({2 * j} * {xi}) * {inner}({2 * j} * {eta})" for j, c in enumerate(terms, 1))


def polygon_join(source: str, corners: int = 120) -> str:
    """CTEs after `grid`: `touch` (id, hex_id), circles of `source` drawn as polygons on the UTM plane.

    `source` needs id, longitude, latitude and dist_buffer. Every corner of every circle is worked
    out, every side of it cut at the hexagon, or crossed with every piece of a clipped hexagon.
    """
    k = math.sqrt(E2)
    metres = geodesy.UTM_SCALE * geodesy.RECTIFYING_RADIUS
    e2, e4, e6, e8 = E2, E2**2, E2**3, E2**4
    turn = f"(CAST({-2 * math.pi / corners!r} AS DOUBLE) * i)"
    return f"""
{cells_of(source, 'spot')},
conformal AS (SELECT *, sinh(atanh(sin(radians(latitude))) - {k!r} * atanh({k!r} * sin(radians(latitude)))) AS t,
    radians(longitude + 39.0) AS l FROM spot),
sphere AS (SELECT *, atan2(t, cos(l)) AS xi0, atanh(sin(l) / sqrt(1 + t * t)) AS eta0 FROM conformal),
utm AS (SELECT *, {_turned(geodesy.ALPHA, '+', 'xi0', 'eta0', 'sin', 'cosh')} AS north,
    {_turned(geodesy.ALPHA, '+', 'eta0', 'xi0', 'sinh', 'cos')} AS east FROM sphere),
turns AS (SELECT unnest(range({corners})) AS i),
ring AS (SELECT id, i, north + dist_buffer * sin({turn}) / {metres!r} AS xi, east + dist_buffer * cos({turn}) / {metres!r} AS eta FROM utm, turns),
ring_back AS (SELECT id, i, {_turned(geodesy.BETA, '-', 'xi', 'eta', 'sin', 'cosh')} AS xi,
    {_turned(geodesy.BETA, '-', 'eta', 'xi', 'sinh', 'cos')} AS eta FROM ring),
ring_sphere AS (SELECT id, i, asin(sin(xi) / cosh(eta)) AS chi, atan2(sinh(eta), cos(xi)) AS l FROM ring_back),
ring_map AS (SELECT id, i, {R} * (l - radians(39.0)) AS x, chi + {e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360!r} * sin(2 * chi)
    + {7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520!r} * sin(4 * chi) + {7 * e6 / 120 + 81 * e8 / 1120!r} * sin(6 * chi)
    + {4279 * e8 / 161280!r} * sin(8 * chi) AS phi FROM ring_sphere),
ring_flat AS MATERIALIZED (SELECT id, i, x, {R} * ln(tan({math.pi / 4} + phi / 2)) AS y FROM ring_map),
ring_sides AS MATERIALIZED (SELECT a.id, a.i, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM ring_flat a JOIN ring_flat b ON b.id = a.id AND b.i = (a.i + 1) % {corners}),
candidates AS MATERIALIZED (SELECT s.id, g.hex_id, g.q, g.r, g.cx, g.cy, g.is_border
  FROM spot s JOIN (VALUES (0,0),(1,0),(-1,0),(0,1),(0,-1),(1,-1),(-1,1)) AS o(a, b) ON TRUE
  JOIN grid g ON g.q = s.q + o.a AND g.r = s.r + o.b
  WHERE sqrt(pow(s.mx - g.cx, 2) + pow(s.my - g.cy, 2)) <= {E} + 2 * s.dist_buffer),
whole_cuts AS (SELECT id, hex_id, cx, cy, x1, y1, x2, y2, {_clip()}
  FROM candidates JOIN ring_sides USING (id) WHERE NOT is_border),
whole_touch AS (SELECT id, hex_id FROM whole_cuts GROUP BY id, hex_id
  HAVING bool_or(t0 <= t1) OR count(*) FILTER (WHERE (y1 > cy) <> (y2 > cy) AND cx < (x2 - x1) * (cy - y1) / (y2 - y1) + x1) % 2 = 1),
piece_sides AS (SELECT c.id, c.hex_id, p.ax, p.ay, p.bx, p.b_y, s.i, s.x1, s.y1, s.x2, s.y2,
    (x2 - x1) * (ay - y1) - (y2 - y1) * (ax - x1) AS o1, (x2 - x1) * (b_y - y1) - (y2 - y1) * (bx - x1) AS o2,
    (bx - ax) * (y1 - ay) - (b_y - ay) * (x1 - ax) AS o3, (bx - ax) * (y2 - ay) - (b_y - ay) * (x2 - ax) AS o4
  FROM candidates c JOIN pieces p ON p.q = c.q AND p.r = c.r JOIN ring_sides s ON s.id = c.id WHERE c.is_border),
piece_hits AS (SELECT id, hex_id, bool_or((o1 > 0) <> (o2 > 0) AND (o3 > 0) <> (o4 > 0)) AS crossed,
    count(*) FILTER (WHERE (y1 > ay) <> (y2 > ay) AND ax < (x2 - x1) * (ay - y1) / (y2 - y1) + x1) % 2 = 1 AS held,
    bool_or(i = 0 AND (ay > y1) <> (b_y > y1) AND x1 < (bx - ax) * (y1 - ay) / (b_y - ay) + ax) AS over
  FROM piece_sides GROUP BY id, hex_id, ax, ay, bx, b_y),
touch AS (SELECT id, hex_id FROM whole_touch
  UNION ALL SELECT id, hex_id FROM piece_hits GROUP BY id, hex_id
  HAVING bool_or(crossed OR held) OR count(*) FILTER (WHERE over) % 2 = 1)
"""
