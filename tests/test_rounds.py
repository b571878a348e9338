"""Cards and rounds of attempts: matched once, parsed where taken, the same either way."""

import pytest

import __spark_entry__ as entry
from telhado.operators import clean, extract
from telhado.plans import jobs
from telhado.schemas import PRICE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


GOOD = '"adDetail":{"price":"%s","rooms":2} {&quot;address&quot;:&quot;Rua %s&quot;}'
CUT = '"adDetail":{"price":"1","more":{"a":1}}'


@pytest.fixture
def attempts(spark):
    def pages(url, *html):
        return [(url, n, 200 if h is not None else 503, h) for n, h in enumerate(html, 1)]

    rows = [
        *pages("new", CUT, GOOD % (2, "A")),
        *pages("late", None, None, None, "Are you a human", None, GOOD % (6, "B")),
        *pages("beyond", None, None, None, None, None, None, GOOD % (7, "C")),
        *pages("old", GOOD % (8, "D")),
        *pages("priced", GOOD % (9, "E")),
        *pages("many", *[GOOD % (n, n) for n in range(1, 9)]),
        *pages(None, GOOD % (3, "F")),
    ]
    return spark.createDataFrame(rows, "url string, n int, status int, html string")


def test_unparsed_rounds_fill_ads_like_parsed_ones(spark, attempts):
    listing = spark.createDataFrame([(u, u) for u in ("new", "late", "beyond", "many")], "url string, titulos string")
    previous = spark.createDataFrame(
        [("old", None), ("priced", "5"), (None, None)], f"url string, `{PRICE}` string"
    ).transform(lambda df: jobs.ensure_columns(df, jobs.ADS))
    results = []
    for parse in (True, False):
        records = extract.good_rounds(attempts, "url", ["n"], rounds=2, parse=parse)
        out = jobs.bronze_municipal(previous, listing, records, ["titulos"])
        results.append({r["url"]: (r[PRICE], r["endereco"], r["n_quartos"], r["price_before"]) for r in out.collect()})
    assert results[0] == results[1] == {
        "new": ("2", "Rua A", "2", None), "late": ("6", "Rua B", "2", None), "beyond": (None, None, None, None),
        "old": ("8", "Rua D", "2", None), "priced": ("5", None, None, "5"), "many": ("1", "Rua 1", "2", "1"),
        None: (None, None, None, None),
    }


def test_rounds_of_three(spark, attempts):
    found = extract.first_good_records(attempts, "url", ["n"], at_most=2, rounds=3)
    got = {(r["url"], r["round"]): (r["attempt"], r[PRICE]) for r in found.collect() if r["url"] in ("late", "many", "beyond")}
    assert got == {
        ("late", 1): (None, None), ("late", 2): (None, None), ("late", 3): (6, "6"),
        ("many", 1): (1, "1"), ("many", 2): (2, "2"), ("many", 3): (3, "3"),
        ("beyond", 1): (None, None), ("beyond", 2): (None, None), ("beyond", 3): (None, None),
    }


def test_rounds_gather_no_lists_and_parse_chosen_pages(attempts):
    whole = plan(extract.good_rounds(attempts, "url", ["n"], rounds=2))
    assert "collect_list" not in whole and whole.count("Window [") == 1
    # Parsed above the shuffle, that is in front of it in the plan.
    assert whole.rindex("from_json") < whole.index("Exchange")
    assert "from_json" not in plan(extract.good_rounds(attempts, "url", ["n"], rounds=2, parse=False))


def test_a_filter_on_links_runs_no_pattern_again(spark):
    html = '<section class="adcard"><a href="">x</a><h2></h2></section><section class="adcard"><a href="/b">x</a></section>'
    pages = spark.createDataFrame([(html, 200), (None, 200)], "html string, status int")
    cards = extract.listing(pages)
    assert [(r["pos"], r["url"], r["titulos"]) for r in cards.collect()] == [(0, "", ""), (1, "/b", None)]
    valid = clean.valid_urls(cards)
    assert [r["url"] for r in valid.collect()] == ["/b"]
    assert plan(valid).count("href") == plan(cards).count("href")


def test_ads_are_worked_out_once(spark):
    found = plan(entry.queries()["bronze_from_pages"](spark, "/root/testdata/sf0.001"))
    assert "orders.parquet" not in found and "lineitem.parquet" in found
