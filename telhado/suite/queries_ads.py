"""Queries over listing text: numbers, cleaning, distinct rows, merges, snapshots, indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import numbers as num, text as tx
from ..operators import clean, distinct, extract, indicators as ind, intervals, joins, merge
from ..plans import collection, jobs
from ..schemas import ADS, ADS_WITH_COORDS, PRICE, RECORD_COLUMNS, RECORD_FIELDS, col, ensure_columns
from ..session import fresh_path
from ..sources import snapshots
from .registry import query
from .sql import ROOMS, TEXT_COLUMNS, cents, cep, gold, label, number, silver
from .views import Data

SEARCH = "https://ads.example/search"
RAW_COLUMNS = f"url, titulos, preco_txt AS preco, area_m2, n_quartos, n_banheiros, n_vagas_garagem, {TEXT_COLUMNS}"


def shown(df: DataFrame) -> DataFrame:
    """Price column under a name that needs no quoting in SQL."""
    return df.withColumnRenamed(PRICE, "preco")


def in_cents(df: DataFrame, columns: list[str]) -> DataFrame:
    """Half up at two decimals by plain arithmetic, the same in both engines even at ties."""
    return df.withColumns({c: F.floor(col(c) * 100 + 0.5) / 100 for c in columns})


def rounded(df: DataFrame) -> DataFrame:
    return in_cents(df, ["preco_med", *[r for r in ROOMS if r in df.columns]])


def municipal(d: Data, view: str = "ads") -> DataFrame:
    return d.bronze(view).drop("latitude", "longitude")


# Numbers and labels


@query(
    "parse_number",
    f"SELECT ad_id, {number('preco_txt')} AS preco, {number('area_m2')} AS area_m2, {number('n_quartos')} AS n_quartos FROM ads",
    ("ads",),
)
def _(d: Data):
    return d["ads"].select(
        "ad_id",
        num.parse_number(F.col("preco_txt")).alias("preco"),
        num.parse_number(F.col("area_m2")).alias("area_m2"),
        num.parse_number(F.col("n_quartos")).alias("n_quartos"),
    )


@query(
    "price_repair",
    f"SELECT ad_id, CASE WHEN p < 10000 THEN p * 1000 ELSE p END AS preco FROM (SELECT ad_id, {number('preco_txt')} AS p FROM ads)",
    ("ads",),
)
def _(d: Data):
    return d["ads"].select("ad_id", num.repair_thousands(num.parse_number(F.col("preco_txt"))).alias("preco"))


@query(
    "zero_to_null",
    "SELECT ad_id, "
    + ", ".join(f"nullif({number(c)}, 0) AS {c}" for c in ("n_quartos", "n_banheiros", "n_vagas_garagem"))
    + " FROM ads",
    ("ads",),
)
def _(d: Data):
    counts = ("n_quartos", "n_banheiros", "n_vagas_garagem")
    return d["ads"].select("ad_id", *[num.zero_to_null(num.parse_number(F.col(c))).alias(c) for c in counts])


@query(
    "room_labels",
    f"WITH {silver()} SELECT DISTINCT {label('n_quartos')} AS n_quartos FROM silver WHERE n_quartos IS NOT NULL",
    ("ads",),
)
def _(d: Data):
    return ind.room_labels(jobs.silver_municipal(municipal(d)))


@query(
    "buffer_radius",
    "SELECT ad_id, CASE WHEN cep LIKE '%000' THEN 1000.0::DOUBLE ELSE 100.0::DOUBLE END AS dist_buffer FROM ads",
    ("ads",),
)
def _(d: Data):
    return d["ads"].select("ad_id", tx.buffer_radius(F.col("cep")).alias("dist_buffer"))


@query("standard_cep", f"SELECT ad_id, {cep('cep')} AS cep FROM ads", ("ads",))
def _(d: Data):
    return d["ads"].select("ad_id", tx.standard_cep(F.col("cep")).alias("cep"))


@query(
    "snapshot_stamp",
    "SELECT strftime(seen_at, '%Y%m%d') AS stamp, CAST(year(seen_at) AS INTEGER) AS year_seen, count(*) AS n_ads FROM ads GROUP BY 1, 2",
    ("ads",),
)
def _(d: Data):
    return d["ads"].groupBy(
        tx.snapshot_stamp(F.col("seen_at")).alias("stamp"), F.year("seen_at").alias("year_seen")
    ).agg(F.count(F.lit(1)).alias("n_ads"))


# Filters and projections


@query("valid_urls", "SELECT ad_id, url FROM ads WHERE url IS NOT NULL AND url <> ''", ("ads",))
def _(d: Data):
    return clean.valid_urls(d["ads"]).select("ad_id", "url")


@query(
    "ensure_columns",
    "SELECT url, titulos, " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ["preco", *RECORD_COLUMNS[1:]]) + " FROM ads",
    ("ads",),
)
def _(d: Data):
    return shown(ensure_columns(d["ads"].select("url", "titulos"), ADS))


@query("drop_columns", "SELECT * EXCLUDE (latitude, longitude, seen_at) FROM ads", ("ads",))
def _(d: Data):
    return d["ads"].drop("latitude", "longitude", "seen_at", "not_there")


@query(
    "backfill_candidates", "SELECT ad_id, url FROM ads_prev WHERE preco_txt IS NULL", ("ads_prev",)
)
def _(d: Data):
    return merge.unpriced(d.bronze("ads_prev", "ad_id")).select("ad_id", "url")


@query(
    "urls_to_regeocode",
    "SELECT DISTINCT url FROM ads_prev WHERE url IS NOT NULL AND url <> '' AND (latitude IS NULL OR longitude IS NULL)",
    ("ads_prev",),
)
def _(d: Data):
    return merge.urls_without_coordinates(d["ads_prev"])


@query("parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders")
def _(d: Data):
    return snapshots.read_parquet(d.spark, f"{d.sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")


# Silver and gold, municipal track

MUNIC_OUT = f"url, titulos, preco, area_m2, n_quartos, n_banheiros, n_vagas_garagem, {TEXT_COLUMNS}"


@query("dedupe_except_url", f"WITH {silver()} SELECT {MUNIC_OUT} FROM one_each", ("ads",))
def _(d: Data):
    return shown(distinct.distinct_except(clean.with_numbers(municipal(d)), "url"))


@query("silver_munic", f"WITH {silver()} SELECT {MUNIC_OUT} FROM silver", ("ads",))
def _(d: Data):
    return shown(jobs.silver_municipal(municipal(d)))


@query("silver_hex_clean", f"WITH {silver(coords=True)} SELECT {MUNIC_OUT}, latitude, longitude FROM silver", ("ads",))
def _(d: Data):
    return shown(clean.clean_ads(d.bronze(), need_coordinates=True))


@query(
    "price_stats",
    f"WITH {silver()} SELECT municipio, max(preco) AS preco_max, min(preco) AS preco_min, {cents('avg(preco)')} AS preco_med FROM silver GROUP BY municipio",
    ("ads",),
)
def _(d: Data):
    return rounded(ind.price_stats(jobs.silver_municipal(municipal(d)), "municipio"))


@query(
    "price_per_area",
    f"WITH {silver()} SELECT municipio, round_even(sum(preco) / sum(area_m2), 1) AS preco_medio_area FROM silver WHERE area_m2 > 10 GROUP BY municipio",
    ("ads",),
)
def _(d: Data):
    return ind.price_per_area(jobs.silver_municipal(municipal(d)), "municipio")


@query(
    "rooms_long",
    f"WITH {silver()} SELECT {label('n_quartos')} AS n_quartos, municipio, {cents('avg(preco)')} AS media_quarto "
    "FROM silver WHERE n_quartos IS NOT NULL GROUP BY 1, 2",
    ("ads",),
)
def _(d: Data):
    long = ind.rooms_long(jobs.silver_municipal(municipal(d)), "municipio")
    return in_cents(long, ["media_quarto"])


@query(
    "rooms_pivot",
    f"WITH {silver()}, m AS (SELECT {label('n_quartos')} AS q, municipio, avg(preco) AS m FROM silver WHERE n_quartos IS NOT NULL GROUP BY 1, 2) "
    "SELECT municipio, " + ", ".join(f"""max(CASE WHEN q = '{r}' THEN {cents('m')} END) AS "{r}" """ for r in ROOMS) + " FROM m GROUP BY municipio",
    ("ads",),
)
def _(d: Data):
    wide = ind.rooms_pivot(jobs.silver_municipal(municipal(d)), "municipio", ROOMS)
    return in_cents(wide, ROOMS)


GOLD_MUNIC = f"WITH {silver()}, {gold('municipio', 'silver')}"


@query("indicators_munic", GOLD_MUNIC, ("ads",))
def indicators_munic(d: Data):
    return rounded(jobs.gold(jobs.silver_municipal(municipal(d)), "municipio", ROOMS))


@query("indicators_munic_joined", GOLD_MUNIC, ("ads",))
def _(d: Data):
    return rounded(ind.indicators_by_join(jobs.silver_municipal(municipal(d)), "municipio", ROOMS))


@query("indicators_munic_found_labels", GOLD_MUNIC, ("ads",))
def _(d: Data):
    """Room labels read from the data, as when the caller names none."""
    return rounded(jobs.gold(jobs.silver_municipal(municipal(d)), "municipio"))


@query(
    "run_metrics",
    f"WITH {silver()} SELECT (SELECT count(*) FROM ads) AS n_read, (SELECT count(*) FROM ads WHERE preco_txt IS NULL) AS n_unpriced, "
    "(SELECT count(*) FROM silver) AS n_valid",
    ("ads",),
)
def _(d: Data):
    ads = municipal(d)
    read = ads.agg(F.count(F.lit(1)).alias("n_read"), F.count_if(col(PRICE).isNull()).alias("n_unpriced"))
    valid = jobs.silver_municipal(ads).agg(F.count(F.lit(1)).alias("n_valid"))
    return joins.union_all([read, valid]).agg(*[F.max(c).alias(c) for c in ("n_read", "n_unpriced", "n_valid")])


@query(
    "written_counts",
    f"WITH {silver()} SELECT count(*) AS n_rows, count(*) FILTER (WHERE area_m2 IS NULL) AS n_without_area, "
    "count(*) FILTER (WHERE n_quartos IS NULL) AS n_without_rooms FROM silver",
    ("ads",),
)
def _(d: Data):
    """Counts of the silver rows, observed while their snapshot is written."""
    root = f"{fresh_path(d.spark, 'counted')}/silver/municipal"
    _, counts = snapshots.write_counted(jobs.silver_municipal(municipal(d)), root, "20240101", **jobs.silver_counts())
    return d.spark.createDataFrame([counts], "n_rows long, n_without_area long, n_without_rooms long")


# Distinct rows and merges


@query(
    "distinct_urls",
    "SELECT DISTINCT url FROM (SELECT url FROM ads_prev UNION ALL SELECT url FROM ads_curr) WHERE url IS NOT NULL AND url <> ''",
    ("ads_prev", "ads_curr"),
)
def _(d: Data):
    return distinct.distinct_keys(joins.union_all([d["ads_prev"].select("url"), d["ads_curr"].select("url")]))


CARD = r"(?s)<li>(.*?)</li>"
CARD_LINK = r'(?s)<a\b[^>]*?\bhref="([^"]*)"'
CARD_TITLE = r"(?s)<a\b[^>]*>(.*?)</a>"


# The references to be expected in the given cards.
SQL_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": "\u00a0", "&amp;": "&"}


def _decoded(c: str) -> str:
    for entity, char in SQL_ENTITIES.items():
        c = f"replace({c}, '{entity}', '{char}')"
    return c


CARDS = f"""
found AS (SELECT page_id, regexp_extract_all(html, '{CARD}', 1) AS c FROM pages),
each_card AS (SELECT page_id, unnest(range(1, len(c) + 1)) AS i, c FROM found),
cards AS (SELECT page_id, CAST(i - 1 AS INTEGER) AS pos,
  CASE WHEN regexp_matches(c[i], '{CARD_LINK}') THEN {_decoded(f"regexp_extract(c[i], '{CARD_LINK}', 1)")} END AS url,
  CASE WHEN regexp_matches(c[i], '{CARD_TITLE}')
       THEN regexp_replace({_decoded(f"regexp_replace(regexp_extract(c[i], '{CARD_TITLE}', 1), '<[^>]*>', '', 'g')")},
         '^[\\s\u00a0]+|[\\s\u00a0]+$', '', 'g') END AS titulos
  FROM each_card)
"""


def cards(d: Data) -> DataFrame:
    return extract.listing_cards(d["pages"].select("page_id", "html"), CARD, CARD_LINK, CARD_TITLE)


@query("listing_cards", f"WITH {CARDS} SELECT page_id, pos, url, titulos FROM cards")
def _(d: Data):
    return cards(d)


@query(
    "first_per_url",
    f"WITH {CARDS} SELECT page_id, pos, url, titulos FROM cards WHERE url IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id, pos) = 1",
)
def _(d: Data):
    return distinct.first_per_key(cards(d).filter(F.col("url").isNotNull()), "url", ["page_id", "pos"])


@query(
    "union_snapshots",
    "SELECT url, titulos, latitude, NULL::VARCHAR AS municipio FROM ads_prev UNION ALL SELECT url, titulos, NULL::DOUBLE, municipio FROM ads_curr",
    ("ads_prev", "ads_curr"),
)
def _(d: Data):
    return joins.union_all(
        [d["ads_prev"].select("url", "titulos", "latitude"), d["ads_curr"].select("url", "titulos", "municipio")]
    )


CURRENT = """
curr AS (SELECT * FROM ads_curr WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY ad_id) = 1)
"""


def current(d: Data) -> DataFrame:
    """Newest ads, one row per URL; the joins on URL that follow need no further shuffle of it."""
    return distinct.first_per_key(d["ads_curr"].filter(F.col("url").isNotNull()), "url", ["ad_id"])


@query(
    "new_urls",
    f"WITH {CURRENT} SELECT c.ad_id, c.url FROM curr c WHERE c.url <> '' "
    "AND NOT EXISTS (SELECT 1 FROM ads_prev p WHERE p.url = c.url)",
    ("ads_prev", "ads_curr"),
)
def _(d: Data):
    return merge.new_rows(clean.valid_urls(current(d)), d["ads_prev"]).select("ad_id", "url")


@query(
    "reprocess_rows",
    f"WITH {CURRENT} SELECT ad_id, url, titulos FROM curr WHERE url IN (SELECT url FROM ads_prev WHERE url <> '' AND (latitude IS NULL OR longitude IS NULL))",
    ("ads_prev", "ads_curr"),
)
def _(d: Data):
    return merge.rows_with_keys(current(d), merge.urls_without_coordinates(d["ads_prev"])).select("ad_id", "url", "titulos")


def _precedence(first: str, second: str) -> str:
    return (
        f"SELECT ad_id, url, titulos, preco_txt FROM (SELECT 0 AS o, * FROM {first} UNION ALL SELECT 1, * FROM {second}) "
        "QUALIFY row_number() OVER (PARTITION BY url ORDER BY o, ad_id) = 1"
    )


def _merged(d: Data, first: str, second: str) -> DataFrame:
    keep = ["ad_id", "url", "titulos", "preco_txt"]
    return merge.merge_by_precedence([d[first].select(keep), d[second].select(keep)], "url", ["ad_id"])


@query("merge_prev_wins", _precedence("ads_prev", "ads_curr"), ("ads_prev", "ads_curr"))
def _(d: Data):
    return _merged(d, "ads_prev", "ads_curr")


@query("merge_new_wins", _precedence("ads_curr", "ads_prev"), ("ads_prev", "ads_curr"))
def _(d: Data):
    return _merged(d, "ads_curr", "ads_prev")


def _filled(old: str, found: str, fields: str, names: dict[str, str]) -> str:
    return ", ".join(f"CASE WHEN {found} THEN {fields}.{f} ELSE {old}.{c} END AS {c}" for f, c in names.items())


SQL_FIELDS = {f: ("preco" if c == PRICE else c) for f, c in RECORD_FIELDS.items()}
ANY_FIELD = f"coalesce({', '.join(RECORD_FIELDS)}) IS NOT NULL"


@query(
    "backfill_merge",
    f"WITH d AS (SELECT * FROM ads_details WHERE {ANY_FIELD}) SELECT a.ad_id, a.url, "
    + _filled("a", "d.url IS NOT NULL", "d", SQL_FIELDS)
    + " FROM (SELECT *, preco_txt AS preco FROM ads_prev QUALIFY row_number() OVER (PARTITION BY url ORDER BY ad_id) = 1) a LEFT JOIN d ON d.url = a.url AND a.preco IS NULL",
    ("ads_prev", "ads_details"),
)
def _(d: Data):
    records = extract.rename_record(d["ads_details"])
    ads = d.bronze("ads_prev", "ad_id").drop("latitude", "longitude", "titulos")
    ads = distinct.first_per_key(ads, "url", ["ad_id"])
    return shown(merge.backfill(ads, records, col(PRICE).isNull()))


@query(
    "failed_urls", f"SELECT url FROM ads_details WHERE NOT ({ANY_FIELD})", ("ads_details",)
)
def _(d: Data):
    return extract.failed_keys(extract.rename_record(d["ads_details"]))


@query(
    "attach_coords",
    f"WITH {CURRENT} SELECT c.ad_id, c.url, p.latitude, p.longitude FROM curr c LEFT JOIN (SELECT url, latitude, longitude FROM ads_prev "
    "WHERE url IS NOT NULL AND url <> '' QUALIFY row_number() OVER (PARTITION BY url ORDER BY ad_id) = 1) p ON p.url = c.url",
    ("ads_prev", "ads_curr"),
)
def _(d: Data):
    coords = merge.previous_coordinates(d["ads_prev"], ["ad_id"])
    return merge.attach_coordinates(current(d), coords).select("ad_id", "url", "latitude", "longitude")


PENDING = f"""
WITH {CURRENT} SELECT c.ad_id, c.url FROM curr c WHERE (
  NOT EXISTS (SELECT 1 FROM ads_prev p WHERE p.url = c.url AND p.url <> '')
  OR c.url IN (SELECT url FROM ads_prev WHERE url <> '' AND (latitude IS NULL OR longitude IS NULL)))
"""


@query("pending_geocode", PENDING, ("ads_prev", "ads_curr"))
def _(d: Data):
    flagged = merge.with_pending_flag(current(d), merge.previous_coordinates(d["ads_prev"], ["ad_id"]))
    return flagged.filter("pending").select("ad_id", "url")


@query("first_run_pending", f"WITH {CURRENT} SELECT ad_id, url FROM curr", ("ads_curr",))
def _(d: Data):
    """No earlier snapshot: every ad is pending."""
    root = snapshots.snapshot_root(fresh_path(d.spark, "empty"), "bronze", "hexagonal")
    previous = snapshots.read_latest_or_empty(d.spark, root, ADS_WITH_COORDS)
    flagged = merge.with_pending_flag(current(d), merge.previous_coordinates(previous, []))
    return flagged.filter("pending").select("ad_id", "url")


# Snapshots


@query(
    "latest_snapshot",
    "SELECT ad_id, url, preco_txt FROM ads WHERE strftime(seen_at, '%Y%m') = (SELECT max(strftime(seen_at, '%Y%m')) FROM ads)",
    ("ads",),
)
def _(d: Data):
    stamp = F.date_format("seen_at", "yyyyMM")
    return snapshots.newest_rows(d["ads"], stamp).select("ad_id", "url", "preco_txt")


@query("snapshot_roundtrip", f"SELECT {RAW_COLUMNS} FROM ads_curr", ("ads_curr",))
def _(d: Data):
    """Two days and a rerun written; the newest run is read back."""
    root = snapshots.snapshot_root(fresh_path(d.spark, "snapshots"), "bronze", "municipal")
    snapshots.write_snapshot(municipal(d, "ads_prev"), root, "20240102")
    snapshots.write_snapshot(municipal(d, "ads_prev"), root, "20240103")
    snapshots.write_snapshot(municipal(d, "ads_curr"), root, "20240103")
    return shown(snapshots.read_latest(d.spark, root))


# Collection planning

BANDS = """
bands AS (
  SELECT i * 50000 AS low, i * 50000 + 49999 AS high FROM range(40) t(i)
  UNION ALL SELECT 2000000 + i * 100000, 2000000 + i * 100000 + 99999 FROM range(80) t(i)
  UNION ALL SELECT 10000000, 10000000000),
priced AS (SELECT ad_id, CASE WHEN p < 10000 THEN p * 1000 ELSE p END AS preco FROM (SELECT ad_id, {n} AS p FROM ads)),
banded AS (SELECT low, high, count(p.ad_id) AS n_ads FROM bands b LEFT JOIN priced p ON p.preco BETWEEN b.low AND b.high GROUP BY low, high)
""".format(n=number("preco_txt"))


def priced(d: Data) -> DataFrame:
    return d["ads"].select("ad_id", num.repair_thousands(num.parse_number(F.col("preco_txt"))).alias("preco"))


@query("price_bands", f"WITH {BANDS} SELECT * FROM banded", ("ads",))
def _(d: Data):
    """All bands, with the ads in each."""
    empty = collection.price_bands(d.spark).withColumn("n_ads", F.lit(0).cast("bigint"))
    both = empty.unionByName(collection.count_by_band(priced(d), "preco"))
    return both.groupBy("low", "high").agg(F.sum("n_ads").alias("n_ads"))


@query("ads_per_band", f"WITH {BANDS} SELECT * FROM banded WHERE n_ads > 0", ("ads",))
def _(d: Data):
    return collection.count_by_band(priced(d), "preco")


@query(
    "ads_per_given_band",
    f"WITH {BANDS} SELECT band_id, g.low, g.high, count(p.ad_id) AS n_ads FROM given_bands g "
    "LEFT JOIN priced p ON p.preco BETWEEN g.low AND g.high GROUP BY band_id, g.low, g.high",
    ("ads", "given_bands"),
)
def _(d: Data):
    """Ads in each of the bands that a table gives."""
    return intervals.count_by_interval(priced(d), d["given_bands"], "preco").withColumnRenamed("n_rows", "n_ads")


@query(
    "band_urls",
    f"WITH {BANDS} SELECT low, high, concat('{SEARCH}?ps=', low, '&pe=', high, '&o=1') AS request_url, n_ads FROM banded WHERE n_ads > 0",
    ("ads",),
)
def _(d: Data):
    return collection.with_request_url(collection.count_by_band(priced(d), "preco"), SEARCH)


@query(
    "geocoder_urls",
    "SELECT ad_id, concat('https://geo.example/json?address=', url_encode(cep), '&components=country:BR') AS request_url FROM ads WHERE cep IS NOT NULL",
    ("ads",),
)
def _(d: Data):
    return d["ads"].filter(F.col("cep").isNotNull()).select(
        "ad_id", tx.geocoder_url("https://geo.example/json", F.col("cep")).alias("request_url")
    )


COUNTED = r"""
counted AS (SELECT request_id, status, CAST(ceil(TRY_CAST(replace(list_extract(regexp_extract_all(result_text, '[0-9]{1,3}(?:\.[0-9]{3})*'), -1), '.', '') AS INTEGER) / 50.0) AS INTEGER) AS n_pages FROM result_texts)
"""


@query("page_counts", f"WITH {COUNTED} SELECT * FROM counted", ("result_texts",))
def _(d: Data):
    return collection.with_page_count(d["result_texts"]).drop("result_text")


@query("bands_with_results", f"WITH {COUNTED} SELECT * FROM counted WHERE status = 200 AND n_pages > 0", ("result_texts",))
def _(d: Data):
    return collection.with_results(collection.with_page_count(d["result_texts"])).drop("result_text")


@query(
    "page_requests",
    f"WITH {COUNTED} SELECT request_id, CAST(unnest(range(1, n_pages + 1)) AS INTEGER) AS page FROM counted WHERE status = 200 AND n_pages > 0",
    ("result_texts",),
)
def _(d: Data):
    return collection.page_requests(collection.with_page_count(d["result_texts"])).select("request_id", "page")


# Extraction

DETAIL = r'"adDetail"\s*:\s*(\{.*?\})'
ADDRESS = r"(\{&quot;address&quot;:.*?\})"


def _json(source: str, keep: str) -> str:
    """CTE `fields`: the ten fields of the first detail and address object of `html`."""
    picks = [
        f"CASE WHEN json_valid(dj) THEN dj ->> '$.{f}' END AS {SQL_FIELDS[f]}"
        for f in ("price", "size", "rooms", "bathrooms", "garage_spaces")
    ] + [
        f"CASE WHEN json_valid(aj) THEN aj ->> '$.{f}' END AS {SQL_FIELDS[f]}"
        for f in ("address", "neighbourhood", "municipality", "zipcode", "uf")
    ]
    return f"""
objects AS (SELECT {keep}, nullif(regexp_extract(html, '{DETAIL}', 1), '') AS dj,
  replace(nullif(regexp_extract(html, '{ADDRESS}', 1), ''), '&quot;', '"') AS aj FROM {source}),
fields AS (SELECT {keep}, dj, {', '.join(picks)} FROM objects)
"""


USABLE = "status = 200 AND html IS NOT NULL AND NOT regexp_matches(html, '(?i)are you a human')"


@query("usable_pages", f"SELECT ad_id, event_id, html FROM fetch_log WHERE {USABLE}", ("fetch_log",))
def _(d: Data):
    return extract.usable_pages(d["fetch_log"]).select("ad_id", "event_id", "html")


@query("ad_detail", f"WITH {_json('fetch_log', 'event_id')} SELECT event_id, preco, area_m2, n_quartos, n_banheiros, n_vagas_garagem FROM fields", ("fetch_log",))
def _(d: Data):
    found = shown(extract.with_record(d["fetch_log"].select("event_id", "html")))
    return found.select("event_id", "preco", "area_m2", "n_quartos", "n_banheiros", "n_vagas_garagem")


@query(
    "ad_address",
    f"WITH {_json('ad_pages', 'ad_id')} SELECT ad_id, endereco, bairro, municipio, cep, UF FROM fields",
    ("ad_pages",),
)
def _(d: Data):
    found = extract.with_record(d["ad_pages"].select("ad_id", "html"))
    return found.select("ad_id", "endereco", "bairro", "municipio", "cep", "UF")


@query(
    "ad_record",
    f"WITH {_json('ad_pages', 'ad_id, url')} SELECT * EXCLUDE (dj) FROM fields",
    ("ad_pages",),
)
def _(d: Data):
    return shown(extract.with_record(d["ad_pages"].select("ad_id", "url", "html")))


@query(
    "bad_json_rate",
    f"WITH {_json('fetch_log', 'event_id')} SELECT count(dj) AS n_found, count(*) FILTER (WHERE NOT json_valid(dj)) AS n_bad FROM fields",
    ("fetch_log",),
)
def _(d: Data):
    return extract.parse_failures(d["fetch_log"])


def _first_good(source: str, key: str, order: str, rounds: int = 1) -> str:
    """CTEs up to `records`: record of the first usable page of each round of three attempts, per key."""
    plain = ", ".join(SQL_FIELDS.values())
    second = f"""
second_round AS MATERIALIZED (SELECT t.{key}, CAST(min(t.attempt) FILTER (WHERE t.good) AS INTEGER) AS attempt
  FROM tried t JOIN first_round f ON f.{key} IS NOT DISTINCT FROM t.{key}
  WHERE t.attempt > coalesce(f.attempt, 3) AND t.attempt <= coalesce(f.attempt, 3) + 3 GROUP BY t.{key}),"""
    also = f" UNION ALL SELECT {key}, 2, attempt FROM second_round"
    return f"""
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS attempt FROM {source}),
tried AS MATERIALIZED (SELECT {key}, attempt, ({USABLE}) AS good, html FROM numbered WHERE attempt <= {3 * rounds}),
first_round AS MATERIALIZED (SELECT {key}, CAST(min(attempt) FILTER (WHERE good) AS INTEGER) AS attempt FROM tried WHERE attempt <= 3 GROUP BY {key}),
{second if rounds > 1 else ""}
best AS MATERIALIZED (SELECT {key}, 1 AS round, attempt FROM first_round{also if rounds > 1 else ""}),
page AS MATERIALIZED (SELECT b.{key}, b.round, b.attempt, t.html FROM best b LEFT JOIN tried t ON t.{key} = b.{key} AND t.attempt = b.attempt),
{_json('page', f'{key}, round, attempt')},
records AS MATERIALIZED (SELECT {key}, round, attempt, {plain} FROM fields)
"""


@query(
    "first_good_attempt",
    f"WITH {_first_good('fetch_log', 'ad_id', 'ts, event_id')} SELECT * EXCLUDE (round) FROM records",
    ("fetch_log",),
)
def _(d: Data):
    found = extract.first_good_records(d["fetch_log"], "ad_id", ["ts", "event_id"])
    return shown(found).drop("round")


@query(
    "first_good_record",
    f"WITH {_first_good('ad_fetches', 'url', 'try_no, tie_1, tie_2', 2)} SELECT * FROM records",
    ("ad_fetches",),
)
def _(d: Data):
    """Two rounds of three attempts."""
    return shown(extract.first_good_records(d["ad_fetches"], "url", ["try_no", "tie_1", "tie_2"], rounds=2))


# Bronze, municipal track

def _filled_from(rec: str, base: str, when: str) -> str:
    hit = f"{rec}.url IS NOT NULL AND {when}"
    return ", ".join(f"CASE WHEN {hit} THEN {rec}.{c} ELSE {base}.{c} END AS {c}" for c in SQL_FIELDS.values())


def _bronze(fresh: str) -> str:
    """CTEs up to `done`, with `fresh` the listing's unseen ads (url, titulos)."""
    return f"""
WITH {_first_good('ad_fetches', 'url', 'try_no, tie_1, tie_2', 2)},
old AS MATERIALIZED (SELECT {RAW_COLUMNS} FROM ads_prev QUALIFY row_number() OVER (PARTITION BY url ORDER BY titulos) = 1),
{fresh},
both_ AS MATERIALIZED (SELECT *, FALSE AS is_new FROM old
  UNION ALL SELECT url, titulos, {', '.join('NULL' for _ in RECORD_COLUMNS)}, TRUE FROM fresh),
rec AS MATERIALIZED (SELECT * FROM records WHERE coalesce({', '.join(SQL_FIELDS.values())}) IS NOT NULL),
once AS MATERIALIZED (SELECT a.url, a.titulos, a.is_new, a.preco AS was, {_filled_from('r', 'a', 'a.preco IS NULL')}
  FROM both_ a LEFT JOIN rec r ON r.url = a.url AND r.round = 1),
done AS MATERIALIZED (SELECT a.url, a.titulos, a.is_new, CASE WHEN a.is_new THEN a.preco ELSE a.was END AS was,
    {_filled_from('r', 'a', 'a.is_new AND a.preco IS NULL')}
  FROM once a LEFT JOIN rec r ON r.url = a.url AND r.round = 2)
"""


UNSEEN = "url IS NOT NULL AND url <> '' AND NOT EXISTS (SELECT 1 FROM ads_prev p WHERE p.url = c.url)"
BRONZE_MUNIC = _bronze(f"fresh AS MATERIALIZED (SELECT url, min(titulos) AS titulos FROM ads_curr c WHERE {UNSEEN} GROUP BY url)")

# From the cards before they become pages, so that no pattern is shared with the query.
BRONZE_FROM_PAGES = _bronze(f"""
fresh AS MATERIALIZED (SELECT url, titulos FROM page_cards c
  WHERE (b + page) % 17 <> 4 AND b % 23 <> 5 AND b % 29 <> 7 AND {UNSEEN}
    AND page <= (SELECT max(m.page) FROM page_cards m WHERE m.b = c.b) - CASE WHEN b % 7 = 3 THEN 1 ELSE 0 END
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY low, page, slot) = 1)""")


def ad_records(d: Data) -> DataFrame:
    return extract.good_rounds(d["ad_fetches"], "url", ["try_no", "tie_1", "tie_2"], rounds=2, parse=False)


def bronze_munic(d: Data) -> DataFrame:
    listing = d["ads_curr"].select("url", "titulos")
    return jobs.bronze_municipal(municipal(d, "ads_prev"), listing, ad_records(d), ["titulos"])


@query(
    "bronze_from_pages",
    f"{BRONZE_FROM_PAGES} SELECT url, titulos, {', '.join(SQL_FIELDS.values())} FROM done",
    ("ads_prev", "page_cards", "ad_fetches"),
    once=True,
)
def _(d: Data):
    """From price bands and landed result pages, by the usual patterns, to the merged table."""
    d.write_once("ads")
    listing = jobs.collected_listing(
        collection.price_bands(d.spark), d["band_answers"], d["listing_pages"], SEARCH
    )
    merged = jobs.bronze_municipal(municipal(d, "ads_prev"), listing, ad_records(d), ["low", "page", "pos", "titulos"])
    return shown(merged).select("url", "titulos", *SQL_FIELDS.values())


@query(
    "bronze_munic",
    f"{BRONZE_MUNIC} SELECT url, titulos, {', '.join(SQL_FIELDS.values())} FROM done",
    ("ads_prev", "ads_curr", "ad_fetches"),
    once=True,
)
def _(d: Data):
    return shown(bronze_munic(d).drop("is_new", "price_before"))


@query(
    "bronze_munic_short_snapshot",
    "SELECT url, titulos, preco IS NULL AS unpriced FROM (SELECT url, min(titulos) AS titulos, NULL AS preco FROM ads_prev GROUP BY url)",
    ("ads_prev",),
)
def _(d: Data):
    """A stored snapshot with two columns only is kept whole; the columns it lacks are NULL."""
    root = f"{fresh_path(d.spark, 'short')}/bronze/municipal"
    short = d["ads_prev"].groupBy("url").agg(F.min("titulos").alias("titulos"))
    snapshots.write_snapshot(short, root, "20240101")
    kept = snapshots.read_latest_or_empty(d.spark, root, ADS)
    return kept.select("url", "titulos", col(PRICE).isNull().alias("unpriced"))


@query(
    "required_snapshot",
    "SELECT url, min(titulos) AS titulos FROM ads_curr GROUP BY url",
    ("ads_curr",),
)
def _(d: Data):
    """The newest complete snapshot of a root that has one; without one the reader stops."""
    root = f"{fresh_path(d.spark, 'required')}/bronze/municipal"
    for stamp, table in (("20240101", "ads_prev"), ("20240102", "ads_curr")):
        snapshots.write_snapshot(d[table].groupBy("url").agg(F.min("titulos").alias("titulos")), root, stamp)
    return snapshots.read_latest(d.spark, root)


@query(
    "change_summary",
    f"{BRONZE_MUNIC} SELECT *, n_new > 0 OR n_unpriced_after < n_unpriced_before AS changed FROM (SELECT count(*) AS n_rows, "
    "count(*) FILTER (WHERE is_new) AS n_new, count(*) FILTER (WHERE was IS NULL) AS n_unpriced_before, "
    "count(*) FILTER (WHERE preco IS NULL) AS n_unpriced_after FROM done)",
    ("ads_prev", "ads_curr", "ad_fetches"),
    once=True,
)
def _(d: Data):
    return jobs.changes(bronze_munic(d))
