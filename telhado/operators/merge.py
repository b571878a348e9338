"""Incremental merges keyed on the ad's URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import all_null, parsed_address, parsed_detail
from ..schemas import COORDS, PRICE, RECORD_COLUMNS, col
from .clean import missing_coordinates, valid_urls
from .distinct import distinct_keys, first_per_key
from .extract import record_fields
from .joins import refuse_columns, union_all

PRIORITY = "__priority"


def new_rows(current: DataFrame, previous: DataFrame, key: str = "url") -> DataFrame:
    """Rows of `current` whose key `previous` does not hold; rows without a key stay and are not shuffled by it."""
    keyed = current.filter(col(key).isNotNull()).join(distinct_keys(previous, key), key, "left_anti")
    return keyed.unionByName(current.filter(col(key).isNull()))


def rows_with_keys(current: DataFrame, keys: DataFrame, key: str = "url") -> DataFrame:
    """Rows of `current` whose key is in `keys`."""
    return current.filter(col(key).isNotNull()).join(distinct_keys(keys, key), key, "left_semi")


def merge_by_precedence(frames: list[DataFrame], key: str, order: list[str | Column]) -> DataFrame:
    """Union of the frames, one row per key: the earliest frame wins, then `order`."""
    ranked = union_all([f.withColumn(PRIORITY, F.lit(i)) for i, f in enumerate(frames)])
    return first_per_key(ranked, key, [PRIORITY, *order]).drop(PRIORITY)


def merge_listing(previous: DataFrame, listing: DataFrame, order: list[str | Column]) -> DataFrame:
    """Previous ads plus never-seen URLs of the listing; `is_new` marks the latter.

    New-key detection, union and de-duplication are one aggregate, hence one shuffle.
    Rows without a URL in the listing are dropped; `previous` is kept as it is.
    """
    old = previous.withColumns({PRIORITY: F.lit(0), "is_new": F.lit(False)})
    new = valid_urls(listing).withColumns({PRIORITY: F.lit(1), "is_new": F.lit(True)})
    return first_per_key(union_all([old, new]), "url", [PRIORITY, *order]).drop(PRIORITY)


def backfill(ads: DataFrame, records: DataFrame, wanted: Column, fields: list[str] | None = None) -> DataFrame:
    """Where `wanted` holds and the record has any field, take all its fields, NULLs included.

    Otherwise the row stays as it is. `records` must be unique on `url`. This is not a
    per-column coalesce: a found record replaces the whole set of fields.
    """
    fields = fields or RECORD_COLUMNS
    record = F.struct(*[col(c) for c in fields]).alias("best")
    rounds = records.select("url", F.struct(record).alias("round_1"))
    return take_round(attach_rounds(ads, rounds, fields), 1, wanted).select(*[col(c) for c in ads.columns])


def attach_rounds(ads: DataFrame, records: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Add `__round_1`, ...: the record of each round of the ad's URL, NULL where it has no field. One join for all rounds.

    `records` has a row per `url` with `round_1`, ... as from `extract.good_rounds`, or a row per `url` and
    `round` as from `extract.first_good_records`; those are gathered by URL first. Rounds not yet parsed come
    along as their JSON texts, which `take_round` parses where it takes them.
    """
    fields = fields or RECORD_COLUMNS
    if "round" in records.columns:
        record = F.struct(F.struct(*[col(c) for c in fields]).alias("best"))
        each = [F.max(F.when(F.col("round") == n, record)).alias(f"round_{n}") for n in (1, 2)]
        records = records.groupBy("url").agg(*each)
    names = [c for c in records.columns if c.startswith("round_")]
    refuse_columns(ads, {"__detail", "__address", "__record", *[f"__{c}" for c in names]})

    def record(name: str) -> Column:
        if "detail" in records.schema[name].dataType["best"].dataType.fieldNames():
            return F.struct(F.col(f"{name}.best.detail"), F.col(f"{name}.best.address")).alias(f"__{name}")
        own = [F.col(f"{name}.best").getField(c) for c in fields]
        return F.when(~all_null(*own), F.struct(*[v.alias(c) for v, c in zip(own, fields)])).alias(f"__{name}")

    return ads.join(records.select("url", *[record(c) for c in names]), "url", "left")


def take_round(joined: DataFrame, n: int, wanted: Column) -> DataFrame:
    """Where `wanted` holds, all fields of the n-th round's record; drops the round."""
    name = f"__round_{n}"
    if joined.schema[name].dataType.fieldNames() == ["detail", "address"]:
        detail, address = (F.when(wanted, F.col(f"{name}.{c}")) for c in ("detail", "address"))
        parsed = joined.withColumns({"__detail": parsed_detail(detail), "__address": parsed_address(address)})
        parsed = parsed.withColumn("__record", F.struct(*record_fields("__detail", "__address")))
        some = F.when(~all_null(*[F.col("__record").getField(c) for c in RECORD_COLUMNS]), F.col("__record"))
        joined = parsed.withColumn(name, some).drop("__detail", "__address", "__record")
    fresh = F.col(name)
    fields = joined.schema[name].dataType.fieldNames()
    hit = wanted & fresh.isNotNull()
    return joined.withColumns({c: F.when(hit, fresh.getField(c)).otherwise(col(c)) for c in fields}).drop(name)


def change_counts(merged: DataFrame, before: str, after: str, is_new: str = "is_new") -> DataFrame:
    """One row: rows, new rows, unpriced rows before and after, and whether anything changed."""
    counted = merged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(is_new)).alias("n_new"),
        F.count_if(col(before).isNull()).alias("n_unpriced_before"),
        F.count_if(col(after).isNull()).alias("n_unpriced_after"),
    )
    changed = (F.col("n_new") > 0) | (F.col("n_unpriced_after") < F.col("n_unpriced_before"))
    return counted.withColumn("changed", changed)


def anything_changes(previous: DataFrame, listing: DataFrame, records: DataFrame, order: list[str | Column]) -> bool:
    """Whether the listing has a URL that `previous` lacks, or an unpriced ad of `previous` now has a priced record.

    Reads URLs and prices only, and stops at the first of either.
    """
    if not new_rows(valid_urls(listing).select("url"), previous.select("url")).isEmpty():
        return True
    # Order columns that only the listing has are NULL for stored rows.
    absent = {o: F.lit(None).cast("string") for o in order if isinstance(o, str) and o not in previous.columns}
    bare = unpriced(first_per_key(previous.withColumns(absent), "url", order)).select("url")
    return not rows_with_keys(records.filter(col(PRICE).isNotNull()).select("url"), bare).isEmpty()


def unpriced(ads: DataFrame) -> DataFrame:
    return ads.filter(col(PRICE).isNull())


def urls_without_coordinates(previous: DataFrame) -> DataFrame:
    return distinct_keys(missing_coordinates(previous))


def previous_coordinates(previous: DataFrame, order: list[str | Column]) -> DataFrame:
    """Per URL of the earlier snapshot: its first coordinates, and whether any row lacked them."""
    rows = valid_urls(previous)
    lacking = F.col("latitude").isNull() | F.col("longitude").isNull()
    rank = F.struct(*[col(o) if isinstance(o, str) else o for o in order], "latitude", "longitude")
    return rows.groupBy("url").agg(
        F.min(F.struct(rank.alias("rank"), "latitude", "longitude")).alias("first"),
        F.max(lacking).alias("lacking"),
    ).select("url", F.col("first.latitude").alias("latitude"), F.col("first.longitude").alias("longitude"), "lacking")


def with_pending_flag(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """`current` with the earlier coordinates of its URL and `pending`: never seen, or lacking coordinates.

    One join answers new-key detection, the re-geocoding set and the carry-over of old coordinates.
    """
    bare = current.drop("latitude", "longitude")
    return bare.join(earlier, "url", "left").withColumn(
        "pending", F.coalesce(F.col("lacking"), F.lit(True))
    ).drop("lacking")


def attach_coordinates(ads: DataFrame, coords: DataFrame) -> DataFrame:
    """Left join of one coordinate pair per URL onto the ads, replacing any they carry."""
    return ads.drop("latitude", "longitude").join(coords.select(*COORDS.fieldNames()), "url", "left")
