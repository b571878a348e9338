"""Listing-shaped views of the given tables, as SQL text that Spark and DuckDB both run.

A name in braces stands for a table or another view; doubled braces are literal ones.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import ADS_WITH_COORDS, PRICE, col
from ..session import materialise

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS: dict[str, str] = {}

VIEWS["ads"] = """
WITH k AS (
  SELECT o_orderkey AS id, o_orderdate,
         CASE WHEN o_orderkey % 20 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS b
  FROM {orders}),
s AS (
  SELECT k.id, k.b, k.o_orderdate, CAST(floor(o.o_totalprice) AS BIGINT) AS p,
         c.c_mktsegment, n.n_name, o.o_orderpriority
  FROM k JOIN {orders} o ON o.o_orderkey = k.b
         JOIN {customer} c ON c.c_custkey = o.o_custkey
         JOIN {nation} n ON n.n_nationkey = c.c_nationkey)
SELECT id AS ad_id, o_orderdate AS seen_at,
  CASE WHEN id % 97 = 5 THEN NULL WHEN id % 89 = 7 THEN ''
       ELSE concat('https://ads.example/', CAST(id AS VARCHAR(20))) END AS url,
  concat('Ad ', CAST(b AS VARCHAR(20))) AS titulos,
  CASE WHEN b % 13 = 3 THEN NULL WHEN b % 101 = 9 THEN '250000000'
       WHEN b % 29 = 4 THEN '0' WHEN b % 11 = 2 THEN 'sob consulta'
       WHEN b % 7 = 6 THEN concat('R$ ', CAST(CAST(floor(p / 1000.0) AS BIGINT) AS VARCHAR(20)), '.',
                                  lpad(CAST(p % 1000 AS VARCHAR(20)), 3, '0'))
       WHEN b % 7 = 5 THEN concat('R$ ', CAST(CAST(floor(p / 1000.0) AS BIGINT) AS VARCHAR(20)))
       ELSE CAST(p AS VARCHAR(20)) END AS preco_txt,
  CASE WHEN b % 9 = 4 THEN NULL ELSE concat(CAST(b % 200 AS VARCHAR(20)), ' m2') END AS area_m2,
  CASE WHEN b % 17 = 8 THEN NULL WHEN b % 10 = 9 THEN '5 ou mais'
       ELSE CAST(b % 6 AS VARCHAR(20)) END AS n_quartos,
  CAST(b % 4 AS VARCHAR(20)) AS n_banheiros, CAST(b % 3 AS VARCHAR(20)) AS n_vagas_garagem,
  o_orderpriority AS endereco, c_mktsegment AS bairro,
  CASE WHEN b % 50 = 12 THEN NULL ELSE n_name END AS municipio,
  CASE WHEN b % 43 = 1 THEN NULL
       WHEN b % 4 = 0 THEN concat('29', lpad(CAST(b % 300 AS VARCHAR(20)), 3, '0'), '-000')
       ELSE concat('29', lpad(CAST(b % 300 AS VARCHAR(20)), 3, '0'),
                   lpad(CAST(b % 7 * 10 + 5 AS VARCHAR(20)), 3, '0')) END AS cep,
  'ES' AS UF,
  CASE WHEN b % 23 = 0 THEN NULL
       ELSE CAST(b * 37 % 3400 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(21.3 AS DOUBLE) END AS latitude,
  CASE WHEN b % 23 = 0 THEN NULL
       ELSE CAST(b * 53 % 2200 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(41.9 AS DOUBLE) END AS longitude
FROM s
"""

VIEWS["ads_prev"] = """
SELECT ad_id, seen_at, url, titulos,
  CASE WHEN ad_id % 31 = 0 THEN NULL ELSE preco_txt END AS preco_txt,
  area_m2, n_quartos, n_banheiros, n_vagas_garagem, endereco, bairro, municipio, cep, UF, latitude, longitude
FROM {ads} WHERE seen_at < TIMESTAMP '2000-01-01 00:00:00'
"""

VIEWS["ads_curr"] = """
SELECT * FROM {ads} WHERE seen_at >= TIMESTAMP '1996-01-01 00:00:00'
"""

# Ten fields per URL, some records empty, some with gaps.
VIEWS["ads_details"] = """
SELECT url,
  CASE WHEN ad_id % 62 = 0 THEN NULL ELSE preco_txt END AS price,
  CASE WHEN ad_id % 62 = 0 OR ad_id % 5 = 0 THEN NULL ELSE area_m2 END AS size,
  CASE WHEN ad_id % 62 = 0 THEN NULL ELSE n_quartos END AS rooms,
  CASE WHEN ad_id % 62 = 0 THEN NULL ELSE n_banheiros END AS bathrooms,
  CASE WHEN ad_id % 62 = 0 OR ad_id % 7 = 0 THEN NULL ELSE n_vagas_garagem END AS garage_spaces,
  CASE WHEN ad_id % 62 = 0 THEN NULL ELSE endereco END AS address,
  CASE WHEN ad_id % 62 = 0 OR ad_id % 4 = 0 THEN NULL ELSE bairro END AS neighbourhood,
  CASE WHEN ad_id % 62 = 0 THEN NULL ELSE municipio END AS municipality,
  CASE WHEN ad_id % 62 = 0 THEN NULL ELSE cep END AS zipcode,
  CASE WHEN ad_id % 62 = 0 THEN NULL ELSE UF END AS uf
FROM {ads} WHERE url IS NOT NULL AND url <> '' AND ad_id % 3 <> 0
"""

VIEWS["cep_points"] = """
SELECT
  concat('29', lpad(CAST(c_custkey % 300 AS VARCHAR(20)), 3, '0'), '-',
         CASE WHEN c_custkey % 4 = 0 THEN '000'
              ELSE lpad(CAST(c_custkey % 7 * 10 + 5 AS VARCHAR(20)), 3, '0') END) AS cep,
  CASE WHEN c_custkey % 19 = 3 THEN NULL
       ELSE CAST(c_custkey * 41 % 3400 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(21.3 AS DOUBLE) END AS latitude,
  CAST(c_custkey * 59 % 2200 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(41.9 AS DOUBLE) AS longitude
FROM {customer}
"""

# Fetch attempts per user, unnumbered: errors, robot checks, good pages, nested JSON.
VIEWS["fetch_log"] = """
SELECT user_id AS ad_id, ts, event_id,
  CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS status,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_type = 'signup' THEN 'Are You a Human?'
       WHEN event_type = 'view' THEN concat('x "adDetail": {{"price":', CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR(20)), ',"size":"70","rooms":2}} y')
       WHEN event_type = 'click' THEN 'x "adDetail": {{"price":1,"more":{{"a":1}}}} y'
       ELSE 'no detail here' END AS html
FROM {events}
"""

# Ad pages: a detail object and an address object, sometimes absent, nested or repeated.
VIEWS["ad_pages"] = """
SELECT ad_id, url,
  concat('<html>',
    CASE WHEN ad_id % 12 = 5 THEN ''
         WHEN ad_id % 12 = 7 THEN '"adDetail": {{"price":1,"more":{{"a":1}}}}'
         ELSE concat('<script>"adDetail" : {{"size":"', coalesce(area_m2, '?'), '","price":"', coalesce(preco_txt, ''),
                     '","rooms":', CAST(ad_id % 6 AS VARCHAR(20)),
                     CASE WHEN ad_id % 5 = 0 THEN '' ELSE concat(',"bathrooms":"', n_banheiros, '"') END,
                     CASE WHEN ad_id % 7 = 0 THEN ',"garage_spaces":null' ELSE '' END, '}}</script>') END,
    CASE WHEN ad_id % 9 = 2 THEN ''
         ELSE concat('<i data="{{&quot;address&quot;:&quot;', endereco, '&quot;,&quot;neighbourhood&quot;:&quot;', bairro,
                     '&quot;,&quot;municipality&quot;:',
                     CASE WHEN municipio IS NULL THEN 'null' ELSE concat('&quot;', municipio, '&quot;') END,
                     ',&quot;zipcode&quot;:&quot;', coalesce(cep, ''), '&quot;',
                     CASE WHEN ad_id % 8 = 3 THEN '' ELSE ',&quot;uf&quot;:&quot;ES&quot;' END, '}}">') END,
    CASE WHEN ad_id % 10 = 1 THEN '"adDetail":{{"price":"9","size":"9"}}' ELSE '' END,
    '</html>') AS html
FROM {ads} WHERE url IS NOT NULL AND url <> ''
"""

# Fetches of ad pages, several per ad: errors, robot checks, empty pages, the page itself.
VIEWS["ad_fetches"] = """
SELECT p.url, l.l_linenumber AS try_no, l.l_partkey AS tie_1, l.l_suppkey AS tie_2,
  CASE WHEN l.l_partkey % 4 = 0 THEN 503 ELSE 200 END AS status,
  CASE WHEN l.l_partkey % 4 = 0 THEN NULL
       WHEN l.l_suppkey % 5 = 1 THEN '<p>ARE YOU A HUMAN?</p>'
       WHEN l.l_suppkey % 11 = 3 THEN '<p>removed</p>'
       ELSE p.html END AS html
FROM {lineitem} l JOIN {ad_pages} p ON p.ad_id = l.l_orderkey
"""

# Cards of result pages, eight ads a page and one that shows up again in the next band. Pages are dealt to 120 bands.
VIEWS["page_cards"] = """
WITH own AS (
  SELECT CAST(floor(ad_id / 8) AS BIGINT) AS g, CAST(ad_id % 8 AS INTEGER) AS slot, ad_id, url, titulos FROM {ads}
  UNION ALL
  SELECT CAST(floor(ad_id / 8) AS BIGINT) - 1, 8, ad_id, url, concat('Again ', titulos) FROM {ads} WHERE ad_id % 8 = 1),
spread AS (SELECT *, g % 120 AS b, CAST(floor(g / 120) AS BIGINT) + 1 AS page FROM own WHERE g >= 0)
SELECT CASE WHEN b < 40 THEN b * 50000 ELSE 2000000 + (b - 40) * 100000 END AS low,
  CASE WHEN b < 40 THEN b * 50000 + 49999 ELSE 2000000 + (b - 40) * 100000 + 99999 END AS high,
  b, page, slot, url, titulos
FROM spread
"""

# Landed result pages: every seventeenth failed; a card may lack its link, and headings hold markup.
VIEWS["listing_pages"] = """
SELECT concat('https://ads.example/search?ps=', CAST(low AS VARCHAR(20)), '&pe=', CAST(high AS VARCHAR(20)),
              '&o=', CAST(page AS VARCHAR(20))) AS request_url,
  CASE WHEN (b + page) % 17 = 4 THEN 503 ELSE 200 END AS status,
  concat('<main>', """ + ", ".join(
    f"coalesce(max(CASE WHEN slot = {k} THEN card END), '')" for k in range(9)
) + """, '</main>') AS html
FROM (SELECT *, concat('<section class="adcard x"><h2 class="t"><b>', titulos, '</b></h2>',
        CASE WHEN url IS NULL THEN '' ELSE concat('<a data-k="1" href="', url, '">see</a>') END, '</section>') AS card
      FROM {page_cards}) AS c
GROUP BY low, high, b, page
"""

# Answers to each band's first page; the last page of a band lies beyond what some answers tell.
VIEWS["band_answers"] = """
SELECT concat('https://ads.example/search?ps=', CAST(low AS VARCHAR(20)), '&pe=', CAST(high AS VARCHAR(20)), '&o=1') AS request_url,
  CASE WHEN b % 23 = 5 THEN 503 ELSE 200 END AS status,
  CASE WHEN b % 29 = 7 THEN 'nenhum anuncio'
       WHEN n >= 1000 THEN concat('1 - 50 de ', CAST(CAST(floor(n / 1000) AS BIGINT) AS VARCHAR(20)), '.',
                                  lpad(CAST(n % 1000 AS VARCHAR(20)), 3, '0'), ' resultados')
       ELSE concat('1 - 50 de ', CAST(n AS VARCHAR(20)), ' resultados') END AS result_text
FROM (SELECT low, high, b, max(page) * 50 - CASE WHEN b % 7 = 3 THEN 50 ELSE 13 END AS n
      FROM {page_cards} GROUP BY low, high, b) AS p
"""

# Answers to first-page requests: the text that tells how many ads were found.
VIEWS["result_texts"] = """
SELECT request_id, status,
  CASE WHEN status <> 200 OR request_id % 17 = 2 THEN NULL
       WHEN request_id % 11 = 3 THEN 'nenhum anuncio'
       WHEN request_id % 13 = 5 THEN '0 resultados'
       WHEN n >= 1000 THEN concat('1 - 50 de 1.', lpad(CAST(n - 1000 AS VARCHAR(20)), 3, '0'), ' resultados')
       ELSE concat('1 - 50 de ', CAST(n AS VARCHAR(20)), ' resultados') END AS result_text
FROM (SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 15 = 4 THEN 503 ELSE 200 END AS status,
             CAST(floor(o_totalprice) AS BIGINT) % 1200 AS n
      FROM {orders}) AS r
"""

# Geocoder answers as JSON text, some refused, some empty, some with two results.
VIEWS["geocoder_log"] = """
SELECT ad_id, url,
  CASE WHEN ad_id % 14 = 3 THEN '{{"status":"ZERO_RESULTS","results":[]}}'
       WHEN ad_id % 15 = 4 THEN '{{"status":"OK","results":[]}}'
       WHEN latitude IS NULL THEN '{{"status":"REQUEST_DENIED"}}'
       ELSE concat('{{"status":"OK","results":[{{"geometry":{{"location":{{"lat":', CAST(latitude AS VARCHAR(40)),
                   ',"lng":', CAST(longitude AS VARCHAR(40)), '}}}}}}',
                   CASE WHEN ad_id % 3 = 0 THEN ',{{"geometry":{{"location":{{"lat":1.5,"lng":2.5}}}}}}' ELSE '' END,
                   ']}}') END AS body
FROM {ads} WHERE url IS NOT NULL AND url <> ''
"""

VIEWS["boundary"] = """
SELECT * FROM (VALUES
  (2018,0,0,-41.0,-20.5),(2018,0,1,-40.0,-20.5),(2018,0,2,-40.0,-18.5),(2018,0,3,-41.0,-18.5),
  (2020,0,0,-41.7,-21.2),(2020,0,1,-40.6,-21.0),(2020,0,2,-39.8,-19.6),(2020,0,3,-40.4,-19.2),
  (2020,0,4,-39.8,-18.2),(2020,0,5,-41.0,-18.0),(2020,0,6,-41.2,-19.8),
  (2999,0,0,0.0,0.0),(2999,0,1,1.0,0.0),(2999,0,2,0.0,1.0)) AS t(year, ring, seq, x, y)
"""

# A part for each nation, with a corner for each of its customers; neighbours overlap, every third has a hole, every sixth an island in it.
VIEWS["boundary_parts"] = """
SELECT k + add_ AS part, ring, seq,
  round(-41.5 + 0.4 * (k % 5) + 0.28 * f * size * cos(6.283185307179586 * seq / n), 9) AS x,
  round(-21.0 + 0.65 * floor(k / 5) + 0.45 * f * size * sin(6.283185307179586 * seq / n), 9) AS y
FROM (SELECT CAST(c_nationkey AS INTEGER) AS k, 1 + (c_custkey * 7919 % 100) / 400.0 AS f,
        CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS seq,
        count(*) OVER (PARTITION BY c_nationkey) AS n
      FROM {customer}) AS c
  JOIN (SELECT * FROM (VALUES (0, 0, 1.0, 1), (0, 1, 0.3, 3), (100, 0, 0.1, 6)) AS v(add_, ring, size, every)) AS rings
  ON k % every = 0 AND n > 2
"""

# Price bands as rows: irregular, some overlapping, some apart, a few very wide.
VIEWS["given_bands"] = """
SELECT c_custkey AS band_id, lo AS low, lo + CASE WHEN c_custkey % 97 = 5 THEN 40000000 WHEN c_custkey % 11 = 3 THEN 0 ELSE c_custkey * 31 % 9000 END AS high
FROM (SELECT c_custkey, CAST(c_custkey * 7919 % 1000003 AS BIGINT) AS lo FROM {customer}) AS c
"""

NEEDS = {
    "ads": ["orders", "customer", "nation"],
    "ads_prev": ["ads"],
    "ads_curr": ["ads"],
    "ads_details": ["ads"],
    "cep_points": ["customer"],
    "fetch_log": ["events"],
    "ad_pages": ["ads"],
    "ad_fetches": ["lineitem", "ad_pages"],
    "page_cards": ["ads"],
    "listing_pages": ["page_cards"],
    "band_answers": ["page_cards"],
    "result_texts": ["orders"],
    "geocoder_log": ["ads"],
    "boundary": [],
    "boundary_parts": ["customer"],
    "given_bands": ["customer"],
}


class Data:
    """The given tables of one folder, and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._seen: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self._load(name)
        return self._seen[name]

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.spark.sql(VIEWS[name], **{n: self[n] for n in NEEDS[name]})

    def write_once(self, name: str) -> None:
        """Work a view out once, for a query whose other views read it many times."""
        self._seen[name] = materialise(self[name], name)

    def bronze(self, view: str = "ads", *extra: str) -> DataFrame:
        """A view of ads in the bronze layout, without its ids, plus `extra` columns."""
        named = self[view].withColumnRenamed("preco_txt", PRICE)
        return named.select(*[col(c) for c in ADS_WITH_COORDS.fieldNames()], *extra)

    @cached_property
    def boundary_2020(self) -> DataFrame:
        return self["boundary"].filter(F.col("year") == 2020)


def sql_text(body: str, *views: str, once: bool = False) -> str:
    """`body` with the named views, and those they rest on, in front as common table expressions.

    With `once`, each view is worked out once however often `body` names it.
    """
    needed: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS[name]:
            if other in VIEWS:
                add(other)
        if name not in needed:
            needed.append(name)

    for view in views:
        add(view)
    names = {n: n for n in [*TABLES, *VIEWS]}
    ctes = [f"{n} AS {'MATERIALIZED ' if once else ''}({VIEWS[n].strip().format(**names)})" for n in needed]
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"
