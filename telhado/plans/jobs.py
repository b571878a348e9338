"""The six layer jobs, each a function of DataFrames, and the runs that read and write snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import WIDE, buffer_radius, standard_cep
from ..operators import boundary, clean, extract, geocode, hexgrid, indicators as ind, merge
from ..operators.distinct import first_per_key
from ..operators.hexjoin import hex_join
from ..operators.joins import lookup_join
from ..schemas import ADS, ADS_WITH_COORDS, COORDS, PRICE, col, ensure_columns
from ..session import materialise, scratch
from ..sources import snapshots
from . import collection


def collected_listing(bands: DataFrame, answers: DataFrame, pages: DataFrame, base: str) -> DataFrame:
    """Cards of all result pages of the price bands: (low, high, page, pos, url, titulos).

    `answers` (request_url, status, result_text) are those to each band's first page, `pages`
    (request_url, status, html) the landed result pages, both unique on `request_url`. Bands without
    results, and pages that failed or were not asked for, drop out.
    """
    first = collection.with_request_url(bands, base).join(answers, "request_url")
    wanted = collection.page_requests(collection.with_page_count(first)).select("low", "high", "page")
    asked = collection.with_request_url(wanted, base, F.col("page"))
    landed = asked.join(pages.select("request_url", "status", "html"), "request_url").drop("request_url")
    return extract.listing(landed)


def bronze_municipal(
    previous: DataFrame, listing: DataFrame, records: DataFrame, order: list[str | Column]
) -> DataFrame:
    """Previous ads, plus new ones of the listing, with missing records filled in.

    `records` holds two rounds of attempts per URL, as from `extract.good_rounds`, parsed or not: JSON texts
    are parsed for those ads that take them. A new ad takes its first
    record, and so does an old ad still without a price; a new ad that has no price even then
    takes its second. Adds `is_new` and `price_before`: the price before unpriced ads were
    tried again.
    """
    price = col(PRICE)
    merged = merge.merge_listing(previous, ensure_columns(listing, ADS), order).withColumn("price_before", price)
    filled = merge.take_round(merge.attach_rounds(merged, records), 1, price.isNull())
    filled = filled.withColumn("price_before", F.when(F.col("is_new"), price).otherwise(F.col("price_before")))
    return merge.take_round(filled, 2, F.col("is_new") & price.isNull())


def changes(bronze: DataFrame) -> DataFrame:
    return merge.change_counts(bronze, "price_before", PRICE)


def bronze_hexagonal(
    raw: DataFrame,
    previous: DataFrame,
    medians: DataFrame,
    order: list[str | Column] = (),
    answers: DataFrame | None = None,
    vertices: DataFrame | None = None,
) -> DataFrame:
    """The newest ads with coordinates: carried over, or looked up where new or still missing.

    A looked-up answer replaces the earlier coordinates even where it is NULL. With the `answers`
    of a geocoder (one point per URL) and a boundary, pending ads take that point where it lies
    inside, and otherwise their postal code's, or the point again where the code has none.
    """
    current = first_per_key(raw.filter(F.col("url").isNotNull()), "url", list(order))
    earlier = merge.previous_coordinates(previous, list(order))
    flagged = merge.with_pending_flag(current, earlier).withColumn(
        "__cep", F.when(F.col("pending"), standard_cep(F.col("cep")))
    )
    table = medians.filter(F.col("cep").isNotNull()).select(
        F.col("cep").alias("__cep"), F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon")
    )
    found = lookup_join(flagged, table, ["__cep"], ["url"], hot_only=True)
    fresh = {"latitude": F.col("__lat"), "longitude": F.col("__lon")}
    if answers is not None:
        answered = first_per_key(answers.select("url", "latitude", "longitude"), "url", [])
        points = boundary.points_in_boundary(answered, vertices, ["url"])
        points = points.withColumnsRenamed({"latitude": "__plat", "longitude": "__plon"})
        found = found.join(points, "url", "left")
        fresh = {
            c: F.when(F.col("inside"), F.col(p)).otherwise(F.coalesce(m, F.col(p)))
            for (c, m), p in zip(fresh.items(), ("__plat", "__plon"))
        }
    chosen = {c: F.when(F.col("pending"), v).otherwise(F.col(c)) for c, v in fresh.items()}
    return found.withColumns(chosen).drop("__cep", "__lat", "__lon", "__plat", "__plon", "inside", "pending")


def silver_municipal(ads: DataFrame) -> DataFrame:
    return clean.clean_ads(ads)


def silver_hexagonal(
    ads: DataFrame, grid: DataFrame, wkt: DataFrame | None = None, quarter: int | None = None
) -> DataFrame:
    """Cleaned ads, one row per touched hexagon; with `wkt`, each row carries its hexagon's outline.

    With `quarter` the circles are polygons of 4 x `quarter` corners instead of ellipses.
    """
    cleaned = clean.clean_ads(ads, need_coordinates=True).withColumn("dist_buffer", buffer_radius(F.col("cep")))
    joined = hex_join(cleaned, grid, ["titulos", "latitude", "longitude"], largest=WIDE, quarter=quarter)
    joined = joined.drop("latitude", "longitude")
    return joined if wkt is None else lookup_join(joined, wkt, ["hex_id"], ["titulos", "url"], hot_only=True)


def gold(silver: DataFrame, key: str, labels: list[str] | None = None) -> DataFrame:
    """Indicators in key order, the NULL group last."""
    return ind.indicators(silver, key, labels).orderBy(F.col(key).asc_nulls_last())


# Runs: read the newest snapshots, write the day's own.


def silver_counts() -> dict[str, Column]:
    return {
        "n_rows": F.count(F.lit(1)),
        "n_without_area": F.count_if(F.col("area_m2").isNull()),
        "n_without_rooms": F.count_if(F.col("n_quartos").isNull()),
    }



def run_bronze_municipal(
    spark: SparkSession, base: str, stamp: str, listing: DataFrame, attempts: DataFrame, order: list[str],
    attempt_order: list[str],
) -> str | None:
    """Write the day's ads; writes nothing and returns None when nothing is new or repaired.

    That is decided from keys and prices alone, before any row is merged.
    """
    root = snapshots.snapshot_root(base, "bronze", "municipal")
    previous = snapshots.read_latest_or_empty(spark, root, ADS)
    with scratch(spark):
        records = materialise(extract.good_rounds(attempts, "url", attempt_order, rounds=2), "records")
        first = records.select("url", F.col("round_1.best").getField(PRICE).alias(PRICE))
        if not merge.anything_changes(previous, listing, first, order):
            return None
        ready = bronze_municipal(previous, listing, records, order)
        return snapshots.write_snapshot(ready.select(*[col(c) for c in ADS.fieldNames()]), root, stamp)


def run_bronze_hexagonal(
    spark: SparkSession, base: str, stamp: str, cep_points: DataFrame,
    answers: DataFrame | None = None, vertices: DataFrame | None = None,
) -> str:
    raw = snapshots.read_latest(spark, snapshots.snapshot_root(base, "bronze", "municipal"))
    root = snapshots.snapshot_root(base, "bronze", "hexagonal")
    previous = snapshots.read_latest_or_empty(spark, root, ADS_WITH_COORDS, tuple(COORDS.fieldNames()))
    with scratch(spark):
        medians = geocode.cep_medians(cep_points)
        out = bronze_hexagonal(raw, previous, medians, answers=answers, vertices=vertices)
        return snapshots.write_snapshot(out.select(*[col(c) for c in ADS_WITH_COORDS.fieldNames()]), root, stamp)


def run_silver_municipal(spark: SparkSession, base: str, stamp: str, report: dict[str, dict] | None = None) -> str:
    """`report`, if given, takes the counts of the rows written."""
    ads = snapshots.read_latest(spark, snapshots.snapshot_root(base, "bronze", "municipal"))
    root = snapshots.snapshot_root(base, "silver", "municipal")
    path, counts = snapshots.write_counted(silver_municipal(ads), root, stamp, **silver_counts())
    if report is not None:
        report["silver/municipal"] = counts
    return path


def run_silver_hexagonal(
    spark: SparkSession, base: str, stamp: str, vertices: DataFrame, report: dict[str, dict] | None = None
) -> str:
    """`vertices` is one edition of the boundary, in degrees; `report` as in `run_silver_municipal`."""
    ads = snapshots.read_latest(spark, snapshots.snapshot_root(base, "bronze", "hexagonal"))
    with scratch(spark):
        grid = materialise(hexgrid.hex_grid(vertices), "hex-grid")
        wkt = materialise(hexgrid.hex_wkt(grid), "hex-wkt")
        path, counts = snapshots.write_counted(
            silver_hexagonal(ads, grid, wkt), snapshots.snapshot_root(base, "silver", "hexagonal"), stamp,
            **silver_counts(), n_off_grid=F.count_if(F.col("hex_id").isNull()),
        )
        if report is not None:
            report["silver/hexagonal"] = counts
        return path


def run_gold(spark: SparkSession, base: str, stamp: str, track: str) -> str:
    silver = snapshots.read_latest(spark, snapshots.snapshot_root(base, "silver", track))
    key = {"municipal": "municipio", "hexagonal": "hex_id"}[track]
    with scratch(spark):
        return snapshots.write_snapshot(gold(silver, key), snapshots.snapshot_root(base, "gold", track), stamp)


def run_day(
    spark: SparkSession, base: str, stamp: str, listing: DataFrame, attempts: DataFrame, cep_points: DataFrame,
    vertices: DataFrame, order: list[str], attempt_order: list[str], answers: DataFrame | None = None,
    report: dict[str, dict] | None = None,
) -> dict[str, str | None]:
    """All six jobs in order; returns the folder each wrote. A failing job stops the day.

    With the `answers` of a geocoder (one point per URL) pending ads take those that lie inside the boundary.
    `report`, if given, takes the counts of the silver rows, observed while they are written.
    """
    done: dict[str, str | None] = {}
    done["bronze/municipal"] = run_bronze_municipal(spark, base, stamp, listing, attempts, order, attempt_order)
    done["bronze/hexagonal"] = run_bronze_hexagonal(
        spark, base, stamp, cep_points, answers, vertices if answers is not None else None
    )
    done["silver/municipal"] = run_silver_municipal(spark, base, stamp, report)
    done["silver/hexagonal"] = run_silver_hexagonal(spark, base, stamp, vertices, report)
    for track in snapshots.TRACKS:
        done[f"gold/{track}"] = run_gold(spark, base, stamp, track)
    return done
