"""Listing cards and ad records from landed HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as tx
from ..schemas import ADDRESS_FIELDS, DETAIL_FIELDS, RECORD_COLUMNS, RECORD_FIELDS, col


def listing_cards(
    pages: DataFrame,
    card: str = tx.CARD_PATTERN,
    link: str = tx.LINK_PATTERN,
    title: str = tx.TITLE_PATTERN,
) -> DataFrame:
    """One row per card, in page order: the page's own columns, `pos`, `url`, `titulos`.

    A card without link or heading keeps its row with NULL there.
    """
    keep = [c for c in pages.columns if c not in ("html", "url", "titulos")]

    def first(body: Column, pattern: str) -> Column:
        # The array names what was found, so that it is looked for once; only an empty text may mean no match.
        found = F.array(F.regexp_extract(body, pattern, 1))
        return F.transform(found, lambda t: F.when((t != "") | body.rlike(pattern), t))[0]

    # Matched inside the explode: a filter on the link that Spark moves down stops there, and no pattern runs twice.
    found = F.transform(
        F.regexp_extract_all(F.col("html"), F.lit(card), F.lit(1)),
        lambda body: F.struct(first(body, link).alias("link"), tx.without_tags(first(body, title)).alias("title")),
    )
    return pages.select(*[col(c) for c in keep], F.posexplode(found)).select(
        *[col(c) for c in keep],
        "pos",
        tx.decode_entities(F.col("col.link")).alias("url"),
        tx.decoded_and_trimmed(F.col("col.title")).alias("titulos"),
    )


def listing(pages: DataFrame, **patterns: str) -> DataFrame:
    """Cards of every listing page that was fetched; pages that failed drop out."""
    return listing_cards(pages.filter(F.col("status") == 200), **patterns).drop("status")


def usable_pages(attempts: DataFrame) -> DataFrame:
    return attempts.filter(tx.usable_page(F.col("status"), F.col("html")))


def with_record(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the page text with the ten fields of its first detail and address object."""
    parsed = pages.select(
        *[col(c) for c in pages.columns if c != html],
        tx.detail_struct(F.col(html)).alias("__detail"),
        tx.address_struct(F.col(html)).alias("__address"),
    )
    return parsed.select(
        *[c for c in parsed.columns if not c.startswith("__")], *record_fields("__detail", "__address")
    )


def record_fields(detail: str, address: str) -> list[Column]:
    """The ten fields of a parsed detail and address object."""
    fields = [valid_field(detail, f).alias(n) for f, n in DETAIL_FIELDS.items()]
    return fields + [valid_field(address, f).alias(n) for f, n in ADDRESS_FIELDS.items()]


def valid_field(struct: str, field: str) -> Column:
    return F.when(F.col(f"{struct}.{tx.CORRUPT}").isNull(), F.col(f"{struct}.{field}"))


def number_attempts(attempts: DataFrame, key: str, order: list[str], at_most: int = 3) -> DataFrame:
    """The first `at_most` attempts of each key, numbered from 1 in `attempt`.

    The bound on the row number lets Spark cut each key to `at_most` rows per task
    before the shuffle, so a key with very many attempts does not travel.
    """
    order_by = Window.partitionBy(col(key)).orderBy(*[col(o) for o in order])
    return attempts.withColumn("attempt", F.row_number().over(order_by)).filter(F.col("attempt") <= at_most)


def good_rounds(
    attempts: DataFrame, key: str, order: list[str], at_most: int = 3, rounds: int = 1, parse: bool = True
) -> DataFrame:
    """Per key the record of the first usable page of each round: (key, round_1, ..., round_n).

    A round is struct(round, best, tried); `best` is struct(attempt, usable, fields), NULL where no
    page of at most `at_most` attempts was usable. Without `parse` it holds the JSON texts `detail` and
    `address` instead of the fields, for a caller that takes few of the records.

    A round ends at its first usable page, or after `at_most` attempts; the next one, numbered on
    in `round`, begins right behind. A usable page wins even if it holds no field. Attempts
    are those of one run: pass the day's own. The JSON texts are cut out of the pages before the rows move,
    so only these are shuffled, once, and a key has at most `at_most * rounds` of them. The n-th round
    can end at none but the first n usable pages, so these alone are gathered, and only the chosen ones parsed.
    """
    usable = tx.usable_page(F.col("status"), F.col("html"))
    kept = [col(key), *[col(o) for o in order if o != key]]
    # In two steps, so that the test for usable pages runs once.
    pages = attempts.select(*kept, usable.alias("usable"), F.when(usable, F.col("html")).alias("html"))
    texts = [tx.detail_json(F.col("html")).alias("detail"), tx.address_json(F.col("html")).alias("address")]
    found = pages.select(*kept, "usable", *texts)
    # Frame of the row number, so that one window serves both and the bound on its rows stays.
    so_far = Window.partitionBy(col(key)).orderBy(*[col(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("nth", F.count(F.when(F.col("usable"), 1)).over(so_far))
    numbered = number_attempts(found, key, order, at_most * rounds)
    entry = F.struct("attempt", "usable", "detail", "address")
    own = [F.max(F.when(F.col("usable") & (F.col("nth") == n), entry)).alias(f"good_{n}") for n in range(1, rounds + 1)]
    tried = numbered.groupBy(col(key)).agg(F.max("attempt").alias("attempts"), *own).withColumn("ended", F.lit(0))
    for n in range(1, rounds + 1):
        inside = [
            F.when(F.col(f"good_{k}.attempt").between(F.col("ended") + 1, F.col("ended") + at_most), F.col(f"good_{k}"))
            for k in range(1, n + 1)
        ]
        best = tried.withColumns({f"best_{n}": F.coalesce(*inside), f"tried_{n}": F.col("attempts") > F.col("ended")})
        tried = best.withColumn("ended", F.coalesce(F.col(f"best_{n}.attempt"), F.col("ended") + at_most))
    numbers = range(1, rounds + 1)
    if parse:
        details = {f"detail_{n}": tx.parsed_detail(F.col(f"best_{n}.detail")) for n in numbers}
        addresses = {f"address_{n}": tx.parsed_address(F.col(f"best_{n}.address")) for n in numbers}
        tried = tried.withColumns(details | addresses)

    def done(n: int) -> Column:
        best = F.col(f"best_{n}")
        if parse:
            fields = record_fields(f"detail_{n}", f"address_{n}")
            best = F.when(best.isNotNull(), F.struct(best["attempt"].alias("attempt"), best["usable"].alias("usable"), *fields))
        return F.struct(F.lit(n).alias("round"), best.alias("best"), F.col(f"tried_{n}").alias("tried"))

    return tried.select(col(key), *[done(n).alias(f"round_{n}") for n in numbers])


def first_good_records(
    attempts: DataFrame, key: str, order: list[str], at_most: int = 3, rounds: int = 1
) -> DataFrame:
    """`good_rounds` as a row per key and attempted round: key, round, attempt and the ten fields.

    `attempt` and all fields are NULL where no page was usable.
    """
    tried = good_rounds(attempts, key, order, at_most, rounds)
    each = tried.select(col(key), F.explode(F.array(*[f"round_{n}" for n in range(1, rounds + 1)])).alias("r"))
    return each.where("r.tried").select(
        col(key), "r.round", *[F.col("r.best").getField(c).alias(c) for c in ["attempt", *RECORD_COLUMNS]]
    )


def rename_record(df: DataFrame) -> DataFrame:
    """Source field names to table column names."""
    return df.withColumnsRenamed(RECORD_FIELDS)


def failed_keys(records: DataFrame, key: str = "url") -> DataFrame:
    """Keys whose record holds no field at all."""
    return records.filter(tx.all_null(*[col(c) for c in RECORD_COLUMNS])).select(col(key))


def parse_failures(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row: pages with a detail object, and how many of those did not parse."""
    found = pages.select(tx.detail_struct(F.col(html)).alias("d"), tx.detail_json(F.col(html)).alias("j"))
    return found.agg(
        F.count("j").alias("n_found"),
        F.count_if(F.col(f"d.{tx.CORRUPT}").isNotNull()).alias("n_bad"),
    )
