"""Column functions on hand-written values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from telhado.functions import geodesy, hexes, numbers as num, text as tx
from telhado.plans import collection


def values(spark, data, ddl, *exprs):
    return [tuple(r) for r in spark.createDataFrame(data, ddl).select(*exprs).collect()]


@pytest.mark.parametrize(
    "text, number",
    [
        ("R$ 350.000", 350.0),
        ("1.250.000", 1.25),
        ("R$ 1.250.000,50", 1.25),
        ("1,250,000.5", 1250000.5),
        ("70 m2", 70.0),
        ("5 ou mais", 5.0),
        ("-3", -3.0),
        (".5", 0.5),
        ("2e3 m", 2000.0),
        ("3em", 3.0),
        ("Av. 5", None),
        ("a-b 5", None),
        ("-", None),
        ("sob consulta", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_number(spark, text, number):
    assert values(spark, [(text,)], "t string", num.parse_number(F.col("t"))) == [(number,)]


def test_parse_number_other_marks(spark):
    got = values(spark, [("R$ 1.250.000,50",)], "t string", num.parse_number(F.col("t"), ".", ","))
    assert got == [(1250000.5,)]


def test_repair_and_zero(spark):
    data = [(350.0,), (9999.0,), (10000.0,), (0.0,), (None,)]
    got = values(spark, data, "p double", num.repair_thousands(F.col("p")), num.zero_to_null(F.col("p")))
    assert got == [(350000.0, 350.0), (9999000.0, 9999.0), (10000.0, 10000.0), (0.0, None), (None, None)]


def test_room_label(spark):
    got = values(spark, [(1.0,), (3.0,), (2.5,), (1e20,), (None,)], "n double", num.room_label(F.col("n")))
    assert got == [("1_quarto",), ("3_quartos",), ("2.5_quartos",), ("1.0E20_quartos",), (None,)]


def test_page_count(spark):
    data = [("1 - 50 de 12.345 resultados",), ("1 - 3 de 3",), ("nenhum",), (None,), ("0 resultados",), ("12345",)]
    got = values(spark, data, "t string", num.page_count(F.col("t")))
    # Digits without dots are read in threes, so the last count of "12345" is 45.
    assert got == [(247,), (1,), (None,), (None,), (0,), (1,)]


def test_page_fan_out(spark):
    data = [(1, 200, "1 - 50 de 101"), (2, 200, "0"), (3, 200, None), (4, 503, "9"), (5, 200, "nenhum")]
    answers = collection.with_page_count(spark.createDataFrame(data, "id int, status int, result_text string"))
    pages = collection.page_requests(answers).select("id", "page").collect()
    assert sorted(map(tuple, pages)) == [(1, 1), (1, 2), (1, 3)]


def test_bands(spark):
    bands = [tuple(r) for r in collection.price_bands(spark).orderBy("low").collect()]
    assert len(bands) == 121
    assert bands[0] == (0, 49999) and bands[40] == (2000000, 2099999) and bands[-1] == (10000000, 10000000000)
    prices = [-1.0, 0.0, 49999.0, 49999.5, 50000.0, 1999999.0, 2000000.0, 9999999.5, 1e7, 1e10, 1e10 + 1, None]
    ads = spark.createDataFrame([(p,) for p in prices], "price double")
    got = {r["low"]: r["n_ads"] for r in collection.count_by_band(ads, "price").collect()}
    want = {}
    for p in prices:
        for low, high in bands:
            if p is not None and low <= p <= high:
                want[low] = want.get(low, 0) + 1
    assert got == want


def test_cep_and_radius(spark):
    data = [("29.100-000",), ("1310-100",), ("29003035",), ("123456789",), ("x",), (None,)]
    got = values(spark, data, "c string", tx.standard_cep(F.col("c")), tx.buffer_radius(F.col("c")))
    assert [g[0] for g in got] == ["29100-000", "01310-100", "29003-035", None, None, None]
    assert [g[1] for g in got] == [1000.0, 100.0, 100.0, 100.0, 100.0, 100.0]


def test_usable_page(spark):
    data = [(200, "ok"), (200, "... are YOU a Human ..."), (200, None), (503, "ok"), (None, "ok")]
    got = values(spark, data, "s int, h string", tx.usable_page(F.col("s"), F.col("h")))
    assert got == [(True,), (False,), (False,), (False,), (False,)]


def test_plain_text(spark):
    cases = {
        "  a <b>b</b>\n": "a b",
        "&nbsp;Jo&atilde;o &amp; Cia&nbsp;": "João & Cia",
        "&amp;lt; &lt;x&gt; &quot;&apos;": "&lt; <x> \"'",
        "D&#39;&#225;gua &#xE7; &#128512; &#bad; &#1;": "D'água ç 😀 &#bad; \x01",
        "R&D; &euro; 5 &ndash; &amp;#39;": "R&D; € 5 – &#39;",
        "": "",
        "plain": "plain",
    }
    got = values(spark, [(t,) for t in [*cases, None]], "t string", "t", tx.plain_text(F.col("t")))
    assert dict(got) == {**cases, None: None}


def test_urls(spark):
    row = spark.range(1).select(
        tx.search_url("https://a.example/s", F.lit(10_000_000), F.lit(10_000_000_000), F.lit(3)),
        tx.geocoder_url("https://g.example/j", F.lit("29 100/0")),
    ).head()
    assert row[0] == "https://a.example/s?ps=10000000&pe=10000000000&o=3"
    assert row[1].startswith("https://g.example/j?address=29") and row[1].endswith("&components=country:BR")
    assert " " not in row[1]


def test_mercator_known_points(spark):
    got = values(spark, [(-40.0, -20.0)], "x double, y double", geodesy.mercator_x(F.col("x")), geodesy.mercator_y(F.col("y")))
    assert got[0][0] == pytest.approx(-4452779.6317, abs=1e-3)
    assert got[0][1] == pytest.approx(-2273030.9270, abs=1e-3)


def test_utm_central_meridian_and_back(spark):
    data = [(-39.0, 0.0), (-39.0, -20.0), (-41.7, -21.3), (-36.1, -17.9), (-40.3, -20.3)]
    utm = geodesy.utm_xy(F.col("x"), F.col("y"))
    back = geodesy.utm_lonlat(utm["easting"], utm["northing"])
    got = values(spark, data, "x double, y double", utm["easting"], utm["northing"], back["longitude"], back["latitude"])
    assert got[0][:2] == pytest.approx((500000.0, 10000000.0), abs=1e-6)
    assert got[1][0] == pytest.approx(500000.0, abs=1e-6)
    for (lon, lat), row in zip(data, got):
        assert row[2:] == pytest.approx((lon, lat), abs=1e-9)


def test_utm_scale_matches_finite_difference(spark):
    """One metre east and north on the ellipsoid, measured on the plane."""
    lon, lat = -41.2, -20.4
    e2 = geodesy.E2
    w = 1 - e2 * math.sin(math.radians(lat)) ** 2
    nu = geodesy.SEMI_MAJOR / math.sqrt(w)
    rho = geodesy.SEMI_MAJOR * (1 - e2) / w**1.5
    d = 10.0
    east = math.degrees(d / (nu * math.cos(math.radians(lat))))
    north = math.degrees(d / rho)
    data = [(lon, lat), (lon + east, lat), (lon, lat + north)]
    utm = geodesy.utm_xy(F.col("x"), F.col("y"))
    p = values(spark, data, "x double, y double", utm["easting"], utm["northing"], geodesy.utm_point_scale(F.col("x"), F.col("y")))
    for other in p[1:]:
        assert math.dist(p[0][:2], other[:2]) / d == pytest.approx(p[0][2], abs=1e-6)


def test_reach_matches_projected_circle(spark):
    """Half axes against a UTM circle carried over point by point."""
    lon, lat, radius = -40.9, -20.6, 1000.0
    utm = geodesy.utm_xy(F.col("x"), F.col("y"))
    reach = geodesy.mercator_reach(F.lit(radius), F.col("x"), F.col("y"))
    e, n, rx, ry = values(spark, [(lon, lat)], "x double, y double", utm["easting"], utm["northing"], reach["x"], reach["y"])[0]
    ring = [(e + radius * math.cos(t / 50), n + radius * math.sin(t / 50)) for t in range(315)]
    back = geodesy.utm_lonlat(F.col("e"), F.col("n"))
    flat = values(
        spark, [(e, n), *ring], "e double, n double", geodesy.mercator_x(back["longitude"]), geodesy.mercator_y(back["latitude"])
    )
    (cx, cy), outline = flat[0], flat[1:]
    assert max(x - cx for x, _ in outline) == pytest.approx(rx, abs=0.5)
    assert max(y - cy for _, y in outline) == pytest.approx(ry, abs=0.5)


def test_buffer_ring(spark):
    ads = spark.createDataFrame([(-40.3, -20.3, 1000.0)], "longitude double, latitude double, dist_buffer double")
    wkt = geodesy.with_buffer_wkt(ads).head()["buffer_wkt"]
    points = [tuple(map(float, p.split())) for p in wkt.removeprefix("POLYGON ((").removesuffix("))").split(", ")]
    assert len(points) == 121 and points[0] == points[-1]
    for lon, lat in points:
        north, east = (lat + 20.3) * 110700, (lon + 40.3) * 111320 * math.cos(math.radians(20.3))
        assert math.hypot(north, east) == pytest.approx(1000, rel=0.005)


def test_cell_centre_maps_to_itself(spark):
    cells = spark.range(-12, 13).select(F.col("id").cast("int").alias("q")).crossJoin(
        spark.range(-12, 13).select(F.col("id").cast("int").alias("r"))
    )
    cell = hexes.cell_of(hexes.centre_x(F.col("q"), F.col("r")), hexes.centre_y(F.col("r")))
    assert cells.filter((cell["q"] != F.col("q")) | (cell["r"] != F.col("r"))).count() == 0


@pytest.mark.parametrize("u, v, touches", [
    (2500 + 99.9, 0.0, True), (2500 + 100.1, 0.0, False),
    (0.0, 5000 / math.sqrt(3) + 99.9, True), (0.0, 5000 / math.sqrt(3) + 100.1, False),
    ((2500 + 99.9) / 2, (2500 + 99.9) * math.sqrt(3) / 2, True),
    ((2500 + 100.1) / 2, (2500 + 100.1) * math.sqrt(3) / 2, False),
    (0.0, 0.0, True),
])
def test_circle_next_to_a_side(spark, u, v, touches):
    hit = hexes.touches_hexagon(F.col("u"), F.col("v"), F.lit(100.0), F.lit(hexes.side(5000.0) / 2))
    assert values(spark, [(float(u), float(v))], "u double, v double", hit) == [(touches,)]


def read_number(text):
    """Character by character: start at the first digit, minus or full stop; skip commas."""
    start = next((i for i, c in enumerate(text) if c in "-.0123456789"), None)
    if start is None:
        return None
    rest, kept, seen, point = text[start:], "", False, False
    if rest[0] == "-":
        kept, rest = "-", rest[1:]
    elif rest[0] == ".":
        kept, rest, point = "0.", rest[1:], True
    for i, c in enumerate(rest):
        if c == ",":
            continue
        if c == "." and not point:
            point, kept = True, kept + "."
        elif c.isdigit():
            seen, kept = True, kept + c
        else:
            power = ""
            if c in "eE" and seen:
                tail = rest[i + 1 :]
                sign = tail[:1] if tail[:1] in ("+", "-") else ""
                digits = ""
                for x in tail[len(sign) :]:
                    if not x.isdigit():
                        break
                    digits += x
                power = f"e{sign}{digits}" if digits else ""
            return float(kept + power) if seen else None
    return float(kept) if seen else None


def test_parse_number_on_random_text(spark):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("-.,0123456789e R$x") for _ in range(rnd.randint(0, 9))) for _ in range(6000)]
    got = values(spark, [(t,) for t in texts], "t string", "t", num.parse_number(F.col("t")))
    wrong = [(t, v, read_number(t)) for t, v in got if v != read_number(t)]
    assert not wrong, wrong[:10]


def test_numbered_references_of_the_whole_range(spark):
    cases = {
        "&#1048577; &#x10FFFD; &#1114111;": "\U00100001 \U0010fffd \U0010ffff",
        "&#00000038; &#x0000026; &#XFFFFF;": "& & \U000fffff",
        "&#1114112; &#x110000; &#9999999; &#x;": "&#1114112; &#x110000; &#9999999; &#x;",
    }
    got = values(spark, [(t,) for t in cases], "t string", "t", tx.plain_text(F.col("t")))
    assert dict(got) == cases
