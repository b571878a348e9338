"""Extraction, cleaning, merges, snapshots, indicators on small tables."""

import os
import statistics

import pytest
from pyspark.sql import functions as F

from telhado.functions.text import result_text
from telhado.operators import clean, distinct, extract, geocode, indicators as ind, joins, merge
from telhado.plans import collection, jobs
from telhado.schemas import ADS, ADS_WITH_COORDS, PRICE, RECORD_COLUMNS, ensure_columns
from telhado.session import shared_dir
from telhado.sources import landed, snapshots


def as_set(df):
    return sorted(map(str, df.collect()))


# Extraction


def test_cards_keep_order_and_gaps(spark):
    html = (
        '<section class="x-adcard"><a data-x="1" href="/a?x=1&amp;y=2">go</a><h2 class="t">\n Casa &amp; <b>lote</b> </h2></section>'
        '<section class="other"><a href="/no">no</a></section>'
        "<section class='adcard wide'><h2>Sem link</h2></section>"
        '<section class="adcard"><a href="/c">c</a></section>'
    )
    got = extract.listing_cards(spark.createDataFrame([(1, 2, html)], "band int, page int, html string")).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r["pos"])] == [
        (1, 2, 0, "/a?x=1&y=2", "Casa & lote"),
        (1, 2, 1, None, "Sem link"),
        (1, 2, 2, "/c", None),
    ]


def test_search_results_to_listing(spark):
    first = '<p class="text-neutral-110 typo-body-small x font-regular"> 1 - 50 de <b>1.051</b> resultados</p>'
    rows = [(0, 200, first), (50000, 200, '<p class="typo-body-small">9</p>'), (100000, 503, first)]
    answers = spark.createDataFrame(rows, "low int, status int, html string").withColumn("result_text", result_text(F.col("html")))
    asked = collection.page_requests(collection.with_page_count(answers))
    assert [r["page"] for r in asked.orderBy("page").collect()] == list(range(1, 23))
    card = '<section class="adcard"><a href="/%s">x</a><h2>T</h2></section>'
    pages = spark.createDataFrame(
        [(0, 1, 200, card % "a" + card % "b"), (0, 2, 503, card % "c"), (50000, 1, 200, card % "a")],
        "low int, page int, status int, html string",
    )
    got = extract.listing(pages).orderBy("low", "page", "pos").collect()
    assert [(r["low"], r["page"], r["pos"], r["url"]) for r in got] == [(0, 1, 0, "/a"), (0, 1, 1, "/b"), (50000, 1, 0, "/a")]


def test_truncated_json_gives_no_fields(spark):
    pages = [
        (1, '"adDetail": {"price":1,"more":{"a":1}}'),
        (2, '"adDetail"  :  {"price":"R$ 1","size":70,"rooms":null} "adDetail":{"price":"2","bathrooms":9}'),
        (3, "nothing"),
        (4, "{&quot;address&quot;:&quot;Rua A&quot;,&quot;uf&quot;:&quot;ES&quot;}"),
    ]
    found = extract.with_record(spark.createDataFrame(pages, "id int, html string"))
    got = {r["id"]: r.asDict() for r in found.collect()}
    assert all(got[1][c] is None for c in RECORD_COLUMNS)
    assert (got[2][PRICE], got[2]["area_m2"], got[2]["n_quartos"], got[2]["n_banheiros"]) == ("R$ 1", "70", None, None)
    assert all(got[3][c] is None for c in RECORD_COLUMNS)
    assert (got[4]["endereco"], got[4]["UF"], got[4]["bairro"]) == ("Rua A", "ES", None)
    assert tuple(extract.parse_failures(spark.createDataFrame(pages, "id int, html string")).head()) == (2, 1)


def test_first_good_attempt(spark):
    good = '"adDetail":{"price":"%s"}'
    rows = [
        ("a", 1, 503, None), ("a", 2, 200, "Are you a HUMAN"), ("a", 3, 200, good % 3), ("a", 4, 200, good % 4),
        ("b", 1, 200, "no fields"), ("b", 2, 200, good % 2),
        ("c", 1, 503, None), ("c", 2, 503, None), ("c", 3, 503, None), ("c", 4, 200, good % 4),
    ]
    log = spark.createDataFrame(rows, "url string, n int, status int, html string")
    got = {r["url"]: (r["attempt"], r[PRICE]) for r in extract.first_good_records(log, "url", ["n"]).collect()}
    assert got == {"a": (3, "3"), "b": (1, None), "c": (None, None)}
    both = extract.first_good_records(log, "url", ["n"], rounds=2).collect()
    assert {(r["url"], r["round"]): (r["attempt"], r[PRICE]) for r in both} == {
        ("a", 1): (3, "3"), ("a", 2): (4, "4"), ("b", 1): (1, None), ("b", 2): (2, "2"), ("c", 1): (None, None),
        ("c", 2): (4, "4"),
    }


def test_second_round_begins_behind_the_first_usable_page(spark, ads):
    good = '"adDetail":{"price":"100"}'
    log = spark.createDataFrame([("new", 1, 200, "no fields"), ("new", 2, 200, good)], "url string, n int, status int, html string")
    records = extract.first_good_records(log, "url", ["n"], rounds=2)
    listing = spark.createDataFrame([("new", "N")], "url string, titulos string")
    out = jobs.bronze_municipal(ads([("old", "O", "1", None)]), listing, records, ["titulos"])
    assert {r["url"]: r[PRICE] for r in out.collect()} == {"new": "100", "old": "1"}


def test_new_ads_are_tried_twice_old_ones_once(spark, ads):
    good = '"adDetail":{"price":"%s"}'
    log = [(u, n, 503, None) for u in ("new", "old") for n in (1, 2, 3)] + [(u, 4, 200, good % 4) for u in ("new", "old")]
    attempts = spark.createDataFrame(log, "url string, n int, status int, html string")
    records = extract.first_good_records(attempts, "url", ["n"], rounds=2)
    listing = spark.createDataFrame([("new", "N"), ("old", "O")], "url string, titulos string")
    out = jobs.bronze_municipal(ads([("old", "O", None, None)]), listing, records, ["titulos"])
    assert {r["url"]: r[PRICE] for r in out.collect()} == {"new": "4", "old": None}
    assert tuple(jobs.changes(out).head()) == (2, 1, 2, 1, True)


def test_attempts_are_cut_before_the_shuffle(spark):
    log = spark.range(1000).select(F.concat(F.lit("u"), F.col("id") % 1).alias("url"), F.col("id").alias("n"), F.lit(200).alias("status"), F.lit("x").alias("html"))
    plan = extract.first_good_records(log, "url", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") > 0 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


# Distinct rows and merges


@pytest.fixture
def ads(spark):
    def make(rows):
        return ensure_columns(spark.createDataFrame(rows, f"url string, titulos string, `{PRICE}` string, n_quartos string"), ADS)

    return make


def test_first_per_key_is_stable_over_partitions(spark):
    rows = spark.range(2000).select(
        F.concat(F.lit("u"), F.col("id") % 37).alias("url"), (F.col("id") * 7919 % 2003).alias("pos"), F.col("id").alias("v")
    )
    want = {}
    for r in rows.collect():
        if r["url"] not in want or r["pos"] < want[r["url"]][0]:
            want[r["url"]] = (r["pos"], r["v"])
    for n in (1, 8):
        got = distinct.first_per_key(rows.repartition(n), "url", ["pos"]).collect()
        assert {r["url"]: (r["pos"], r["v"]) for r in got} == want


def test_distinct_except_url(spark, ads):
    table = ads([("b", "T", "1", None), ("a", "T", "1", None), (None, "T", "1", None), ("c", "T", "2", None)])
    assert sorted(r["url"] for r in distinct.distinct_except(table, "url").collect()) == ["a", "c"]


def test_distinct_except_url_signed_zero(spark):
    table = spark.createDataFrame([("a", 0.0, None), ("b", -0.0, None), ("c", None, None)], "url string, v double, w string")
    assert sorted(r["url"] for r in distinct.distinct_except(table, "url").collect()) == ["a", "c"]


def test_filter_before_dedupe_changes_nothing(ads):
    table = ads([(str(i), f"T{i % 4}", p, "0") for i, p in enumerate(["0", "350", "99.999", "250000000", "x", None, "100000000", "-5"] * 2)])
    late = clean.valid_price(distinct.distinct_except(clean.with_numbers(table), "url"))
    assert as_set(clean.clean_ads(table)) == as_set(late)


def test_merges(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "url string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 8)], "url string, v int")
    for n in (1, 8):
        pair = [old.repartition(n), new.repartition(n)]
        assert sorted(map(tuple, merge.merge_by_precedence(pair, "url", ["v"]).collect())) == [("a", 1), ("b", 2), ("c", 8)]
        assert sorted(map(tuple, merge.merge_by_precedence(pair[::-1], "url", ["v"]).collect())) == [("a", 1), ("b", 9), ("c", 8)]
    assert [r["url"] for r in merge.new_rows(new, old).collect()] == ["c"]
    assert [r["url"] for r in merge.rows_with_keys(new, old).collect()] == ["b"]


def test_backfill_replaces_all_fields(spark, ads):
    table = ads([("a", "T", None, "2"), ("b", "T", None, "2"), ("c", "T", "7", "2"), ("d", "T", None, "2")])
    records = ads([("a", None, "5", None), ("b", None, None, None), ("c", None, "5", "9")]).drop("titulos")
    got = merge.backfill(table, records, F.col(f"`{PRICE}`").isNull())
    assert sorted((r["url"], r[PRICE], r["n_quartos"]) for r in got.collect()) == [
        ("a", "5", None), ("b", None, "2"), ("c", "7", "2"), ("d", None, "2"),
    ]


def test_null_keys_join(spark):
    left = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    right = spark.createDataFrame([(None, 3), ("x", 4)], "k string, b int")
    out = joins.left_join_nullsafe(left, right, "k")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, 1, 3), ("x", 2, 4)], key=str)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_lookup_paths_agree(spark, shuffled_joins):
    left = spark.range(500).select((F.col("id") % 3 * (F.col("id") % 11)).alias("k"), "id")
    right = spark.range(15).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    salted = joins.lookup_join(left, right, ["k"], ["id"])
    assert "__salt" in salted._jdf.queryExecution().executedPlan().toString()
    assert as_set(salted.select("id", "k", "w")) == as_set(left.join(right, "k", "left").select("id", "k", "w"))


# Medians


@pytest.mark.parametrize("range_rows", [1, 3, 10_000])
def test_exact_medians(spark, range_rows):
    rows = [("hot", float(i * i % 997), float(i)) for i in range(1000)]
    rows += [("even", 1.0, 2.0), ("even", 2.0, None), ("even", 8.0, 4.0), ("even", 4.0, 4.5)]
    rows += [("one", 5.0, None), ("same", 3.0, 3.0), ("same", 3.0, 3.0), ("same", 3.0, 3.0), (None, 1.0, 1.0)]
    rows += [(None, float(i % 5), float(i)) for i in range(20)] + [("void", None, None)] * 12
    rows += [("near", 20.0 + i * 1e-9, -1e9 * (i % 7)) for i in range(50)]
    table = spark.createDataFrame(rows, "cep string, latitude double, longitude double")
    got = {r["cep"]: (r["latitude"], r["longitude"]) for r in geocode.cep_medians(table, range_rows).collect()}
    for key in {r[0] for r in rows}:
        for axis in (1, 2):
            present = [r[axis] for r in rows if r[0] == key and r[axis] is not None]
            want = statistics.median(present) if present else None
            assert got[key][axis - 1] == (None if want is None else pytest.approx(want, rel=1e-15)), (key, axis)
    assert len(got) == 7


@pytest.mark.parametrize("range_rows", [1, 3, 10_000])
def test_medians_leave_out_what_is_no_number(spark, range_rows):
    odd = [float("inf"), float("-inf"), float("nan"), None]
    rows = [("a", v, 1.0) for v in odd] + [("a", float(i), -1.7e308 if i % 2 else 1.7e308) for i in range(9)] + [("b", v, v) for v in odd]
    table = spark.createDataFrame(rows, "cep string, latitude double, longitude double")
    got = {r["cep"]: (r["latitude"], r["longitude"]) for r in geocode.cep_medians(table, range_rows).collect()}
    assert got == {"a": (4.0, 1.0), "b": (None, None)}


def test_geocoder_answers(spark):
    ok = '{"status":"OK","results":[{"geometry":{"location":{"lat":-20.5,"lng":-40}}},{"geometry":{"location":{"lat":1,"lng":2}}}]}'
    rows = [("a", ok), ("b", '{"status":"OK","results":[]}'), ("c", '{"status":"DENIED"}'), ("d", "oops"), ("e", None)]
    got = landed.geocoder_points(spark.createDataFrame(rows, "url string, body string")).collect()
    assert [tuple(r) for r in got] == [("a", -20.5, -40.0)]


def test_latest_boundary(spark):
    table = spark.createDataFrame([(1999, 0), (2010, 1), (2020, 2), (2999, 3)], "year int, ring int")
    assert [r["year"] for r in landed.latest_boundary(table, 2026).collect()] == [2020]
    assert [r["year"] for r in landed.latest_boundary(table, 2015).collect()] == [2010]
    with pytest.raises(landed.BoundaryMissing):
        landed.latest_boundary(table, 2005)


# Indicators


def test_indicators(spark):
    rows = [
        ("x", 100.0, 20.0, 1.0), ("x", 300.0, 5.0, 1.0), ("x", 200.0, 30.0, 2.5), ("x", 50.0, None, None),
        (None, 70.0, None, 3.0), ("y", 10.0, 10.0, None),
    ]
    table = spark.createDataFrame(rows, f"municipio string, `{PRICE}` double, area_m2 double, n_quartos double")
    one_pass = jobs.gold(table, "municipio")
    assert one_pass.columns[5:] == ["1_quarto", "2.5_quartos", "3_quartos"]
    assert [tuple(r) for r in one_pass.collect()] == [
        ("x", 300.0, 50.0, 162.5, 6.0, 200.0, 200.0, None),
        ("y", 10.0, 10.0, 10.0, None, None, None, None),
        (None, 70.0, 70.0, 70.0, None, None, None, 70.0),
    ]
    assert as_set(ind.indicators_by_join(table, "municipio")) == as_set(one_pass)


# Snapshots and whole runs


def test_snapshots(spark, tmp_path):
    root = snapshots.snapshot_root(str(tmp_path), "bronze", "municipal")
    with pytest.raises(snapshots.SnapshotMissing):
        snapshots.read_latest(spark, root)
    assert snapshots.read_latest_or_empty(spark, root, ADS_WITH_COORDS).schema == ADS_WITH_COORDS
    snapshots.write_snapshot(spark.range(3), root, "20240109")
    snapshots.write_snapshot(spark.range(5), root, "20240110")
    assert snapshots.read_latest(spark, root).count() == 5
    # A rerun may read the day's snapshot and supersede it.
    snapshots.write_snapshot(snapshots.read_latest(spark, root).filter("id > 0"), root, "20240110")
    assert snapshots.read_latest(spark, root).count() == 4
    # A run cut short is not read.
    broken = snapshots.write_snapshot(spark.range(9), root, "20240111")
    os.remove(os.path.join(broken, "_SUCCESS"))
    assert snapshots.read_latest(spark, root).count() == 4
    # Without the columns that are needed: as good as none.
    assert snapshots.read_latest_or_empty(spark, root, ADS_WITH_COORDS).isEmpty()
    # Without others: the rows stay, and the columns are NULL.
    short = spark.createDataFrame([("u", "t")], "url string, titulos string")
    snapshots.write_snapshot(short, root, "20240111")
    kept = snapshots.read_latest_or_empty(spark, root, ADS)
    assert [(r["url"], r["titulos"], r["UF"]) for r in kept.collect()] == [("u", "t", None)]
    assert snapshots.read_latest_or_empty(spark, root, ADS_WITH_COORDS, ("url", "latitude")).isEmpty()
    # A run that is not wanted leaves nothing behind.
    assert snapshots.write_snapshot(spark.range(7), root, "20240112", keep=lambda: False) is None
    assert not os.path.exists(os.path.join(root, "snapshot_date=20240112", "run=001"))
    assert snapshots.write_snapshot(spark.range(7), root, "20240112", keep=lambda: True).endswith("run=001")
    assert snapshots.read_latest(spark, root).count() == 7
    with pytest.raises(ValueError):
        snapshots.write_snapshot(spark.range(1), root, "2024-01-11")
    with pytest.raises(ValueError):
        snapshots.snapshot_root("/x", "bronze", "other")


def page(price, town, cep):
    return (
        f'"adDetail":{{"price":"{price}","size":"80 m2","rooms":"2","bathrooms":"1","garage_spaces":"0"}}'
        f"{{&quot;address&quot;:&quot;R&quot;,&quot;neighbourhood&quot;:&quot;B&quot;,&quot;municipality&quot;:&quot;{town}&quot;,"
        f"&quot;zipcode&quot;:&quot;{cep}&quot;,&quot;uf&quot;:&quot;ES&quot;}}"
    )


def test_whole_run(spark, tmp_path):
    base = str(tmp_path)
    listing = spark.createDataFrame(
        [("u1", "Casa", 1), ("u2", "Apto", 2), ("u2", "Apto again", 3), ("u3", "Lote", 4), (None, "No link", 5), ("", "Empty", 6)],
        "url string, titulos string, pos int",
    )
    log = [("u1", 1, 200, page("R$ 350.000", "Serra", "29100-000")), ("u2", 1, 503, None), ("u3", 1, 200, "nothing")]
    attempts = spark.createDataFrame(log, "url string, n int, status int, html string")

    def collect(day, attempts):
        return jobs.run_bronze_municipal(spark, base, day, listing, attempts, ["pos"], ["n"])

    # Order columns of the listing are not part of the stored table.
    assert collect("20240101", attempts)
    bronze = snapshots.read_latest(spark, snapshots.snapshot_root(base, "bronze", "municipal"))
    assert sorted((r["url"], r["titulos"], r[PRICE]) for r in bronze.collect()) == [
        ("u1", "Casa", "R$ 350.000"), ("u2", "Apto", None), ("u3", "Lote", None),
    ]
    assert collect("20240102", attempts) is None
    assert snapshots.snapshot_stamps(spark, snapshots.snapshot_root(base, "bronze", "municipal")) == ["20240101"]
    retry = spark.createDataFrame(log + [("u2", 2, 200, page("120000", "Vila Velha", "29200100"))], attempts.schema)
    assert collect("20240103", retry)
    bronze = snapshots.read_latest(spark, snapshots.snapshot_root(base, "bronze", "municipal"))
    assert bronze.count() == 3 and bronze.filter(F.col("url") == "u2").head()["municipio"] == "Vila Velha"

    points = spark.createDataFrame([("29100-000", -20.1, -40.3), ("29100-000", -20.3, -40.3)], "cep string, latitude double, longitude double")
    jobs.run_bronze_hexagonal(spark, base, "20240103", points)
    root = snapshots.snapshot_root(base, "bronze", "hexagonal")
    first = {r["url"]: (r["cep"], r["latitude"], r["longitude"]) for r in snapshots.read_latest(spark, root).collect()}
    assert first["u1"] == ("29100-000", pytest.approx(-20.2), -40.3) and first["u2"] == ("29200100", None, None)
    # The next run looks up only what is missing, and keeps the rest.
    more = spark.createDataFrame([("29100-000", 0.0, 0.0), ("29200-100", -20.4, -40.4)], points.schema)
    jobs.run_bronze_hexagonal(spark, base, "20240104", more)
    second = {r["url"]: (r["latitude"], r["longitude"]) for r in snapshots.read_latest(spark, root).collect()}
    assert second == {"u1": (pytest.approx(-20.2), -40.3), "u2": (-20.4, -40.4), "u3": (None, None)}

    square = [(0, -41.0, -21.0), (1, -40.0, -21.0), (2, -40.0, -20.0), (3, -41.0, -20.0)]
    vertices = spark.createDataFrame([(0, *v) for v in square], "ring int, seq int, x double, y double")
    jobs.run_silver_municipal(spark, base, "20240104")
    shared = os.listdir(shared_dir(spark))
    jobs.run_silver_hexagonal(spark, base, "20240104", vertices)
    assert os.listdir(shared_dir(spark)) == shared
    jobs.run_gold(spark, base, "20240104", "municipal")
    jobs.run_gold(spark, base, "20240104", "hexagonal")
    gold = snapshots.read_latest(spark, snapshots.snapshot_root(base, "gold", "municipal"))
    assert sorted(tuple(r) for r in gold.collect()) == [
        ("Serra", 350000.0, 350000.0, 350000.0, 4375.0, 350000.0),
        ("Vila Velha", 120000.0, 120000.0, 120000.0, 1500.0, 120000.0),
    ]
    silver = snapshots.read_latest(spark, snapshots.snapshot_root(base, "silver", "hexagonal"))
    assert silver.filter(F.col("hex_id").isNull() | F.col("geometry_wkt").isNull()).count() == 0
    assert {r["url"] for r in silver.collect()} == {"u1", "u2"}
    hexes = snapshots.read_latest(spark, snapshots.snapshot_root(base, "gold", "hexagonal"))
    assert hexes.count() == silver.select("hex_id").distinct().count()


def test_run_day(spark, tmp_path):
    """A first day from nothing, then a day on which nothing changed."""
    listing = spark.createDataFrame([("a", "A", 1)], "url string, titulos string, pos int")
    attempts = spark.createDataFrame([("a", 1, 200, page("R$ 90.000", "Serra", "29100000"))], "url string, n int, status int, html string")
    points = spark.createDataFrame([("29100-000", -20.5, -40.5)], "cep string, latitude double, longitude double")
    square = [(0, -41.0, -21.0), (1, -40.0, -21.0), (2, -40.0, -20.0), (3, -41.0, -20.0)]
    vertices = spark.createDataFrame([(0, *v) for v in square], "ring int, seq int, x double, y double")
    days = [
        jobs.run_day(spark, str(tmp_path), day, listing, attempts, points, vertices, ["pos"], ["n"])
        for day in ("20240101", "20240102")
    ]
    assert all(days[0].values()) and len(days[0]) == 6
    assert days[1].pop("bronze/municipal") is None and all(days[1].values())
    for track in snapshots.TRACKS:
        first, second = (as_set(spark.read.parquet(d[f"gold/{track}"])) for d in days)
        assert first == second and first


def test_run_day_with_a_geocoder_and_a_report(spark, tmp_path):
    """Answers inside the boundary are taken, others give way to the postal code; counts come from the writing itself."""
    urls = ["a", "b", "c"]
    listing = spark.createDataFrame([(u, u.upper(), i) for i, u in enumerate(urls)], "url string, titulos string, pos int")
    pages = [(u, 1, 200, page("R$ 90.000", "Serra", "29100000")) for u in urls]
    attempts = spark.createDataFrame(pages, "url string, n int, status int, html string")
    points = spark.createDataFrame([("29100-000", -20.5, -40.5)], "cep string, latitude double, longitude double")
    answers = spark.createDataFrame([("a", -20.25, -40.25), ("b", 10.0, 10.0)], "url string, latitude double, longitude double")
    square = [(0, -41.0, -21.0), (1, -40.0, -21.0), (2, -40.0, -20.0), (3, -41.0, -20.0)]
    vertices = spark.createDataFrame([(0, *v) for v in square], "ring int, seq int, x double, y double")
    report = {}
    wrote = jobs.run_day(
        spark, str(tmp_path), "20240101", listing, attempts, points, vertices, ["pos"], ["n"], answers=answers, report=report
    )
    coords = {r["url"]: (r["latitude"], r["longitude"]) for r in spark.read.parquet(wrote["bronze/hexagonal"]).collect()}
    assert coords == {"a": (-20.25, -40.25), "b": (-20.5, -40.5), "c": (-20.5, -40.5)}
    for name, counts in report.items():
        rows = spark.read.parquet(wrote[name])
        assert counts["n_rows"] == rows.count() >= 3
        assert counts["n_without_area"] == rows.where("area_m2 IS NULL").count()
    assert report["silver/hexagonal"]["n_off_grid"] == 0 and set(report) == {"silver/municipal", "silver/hexagonal"}
    none = snapshots.write_counted(spark.read.parquet(wrote["silver/municipal"]).limit(0), f"{tmp_path}/none", "20240101", n=F.count(F.lit(1)))
    assert none[1] == {"n": 0}


def test_bronze_twice_adds_nothing(spark):
    listing = spark.createDataFrame([("a", "A"), ("b", "B")], "url string, titulos string")
    log = spark.createDataFrame([("a", 1, 200, page("5", "X", "29000000"))], "url string, n int, status int, html string")
    records = extract.first_good_records(log, "url", ["n"])
    once = jobs.bronze_municipal(spark.createDataFrame([], ADS), listing, records, ["titulos"])
    stored = once.drop("is_new", "price_before")
    twice = jobs.bronze_municipal(stored, listing, records, ["titulos"])
    assert as_set(twice.drop("is_new", "price_before")) == as_set(stored)
    assert not jobs.changes(twice).head()["changed"] and jobs.changes(once).head()["changed"]
