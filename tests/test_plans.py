"""Plans: what reaches the scan, how often rows are shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from telhado.operators import clean, distinct, extract, hexjoin, indicators as ind, joins, merge
from telhado.plans import jobs
from telhado.schemas import ADS, PRICE
from telhado.session import materialise


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"\bExchange (?:hash|range|single)", plan(df)))


@pytest.fixture(scope="module")
def ads(spark):
    rows = spark.range(200).select(
        F.concat(F.lit("u"), F.col("id")).alias("url"),
        *[F.col("id").cast("string").alias(c) for c in ADS.fieldNames()[1:]],
    )
    return materialise(rows, "plan-ads")


def test_filters_and_columns_reach_the_scan(spark, ads):
    text = clean.valid_urls(ads).select("url")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PushedFilters: [IsNotNull(url), Not(EqualTo(url,))]" in text
    assert "ReadSchema: struct<url:string>" in text


def test_indicators_read_once_and_shuffle_little(ads):
    typed = clean.with_numbers(ads)
    out = ind.indicators(typed, "municipio", ["1_quarto", "2_quartos"])
    text = plan(out)
    # One shuffle on (key, rooms) of pre-aggregated rows, one of that small table on the key.
    assert shuffles(out) == 2 and text.count("FileScan") == 1
    assert "url" not in re.search(r"ReadSchema: (\S+)", text)[1]


def test_merge_is_one_shuffle(spark, ads, shuffled_joins):
    merged = merge.merge_listing(ads, ads.select("url", "titulos"), ["titulos"])
    assert shuffles(merged) == 1
    records = ads.drop("titulos")
    # The record join adds the records' own shuffle and none of the ads.
    assert shuffles(merge.backfill(merged, records, F.col(f"`{PRICE}`").isNull())) == 2


def test_attempts_shuffle_once_for_two_rounds(spark, ads, shuffled_joins):
    log = ads.select("url", F.col("titulos").alias("n"), F.lit(200).alias("status"), F.col("endereco").alias("html"))
    records = extract.first_good_records(log, "url", ["n"], rounds=2)
    assert shuffles(records) == 1
    full = plan(jobs.bronze_municipal(ads, ads.select("url", "titulos"), records, ["titulos"]))
    assert "Exchange hashpartitioning(url" in full


def test_pending_join_reuses_partitioning(ads, shuffled_joins):
    place = ads.withColumns({"latitude": F.lit(1.0), "longitude": F.col("cep").cast("double")})
    current = distinct.first_per_key(ads, "url", [])
    flagged = merge.with_pending_flag(current, merge.previous_coordinates(place, []))
    assert shuffles(flagged) == 2


def test_lookup_broadcasts_only_small_tables(spark, ads):
    small = materialise(spark.range(10).select(F.col("id").cast("string").alias("cep"), "id"), "small")
    assert "BroadcastHashJoin" in plan(joins.lookup_join(ads, small, ["cep"], ["url"]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(joins.planned_bytes(small)))
        text = plan(joins.lookup_join(ads, small, ["cep"], ["url"]))
        assert joins.SALT in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_salts_follow_the_session_and_the_table(spark):
    table = spark.range(10)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        assert joins.salt_count(table) == 2000
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert joins.salt_count(table) == 64
        assert joins.salt_count(spark.range(10**10)) == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_hot_keys_leave_map_tasks_as_one_row(spark):
    hot = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("url"), F.col("id").alias("v")
    )
    for df in (distinct.first_per_key(hot, "url", ["v"]), distinct.distinct_except(hot.select("url", F.lit(1).alias("w")), "url")):
        text = plan(df)
        assert text.index("Exchange") < text.index("partial_min")


def test_hex_join_joins_once(spark):
    point = "array<struct<ax: double, ay: double, bx: double, by: double>>"
    grid = spark.range(5).select(
        F.col("id").cast("int").alias("hex_id"), F.col("id").cast("int").alias("q"), F.lit(0).alias("r"),
        F.array().cast(point).alias("outline"),
    )
    spots = spark.range(100).select(
        "id", (F.col("id") / 100).alias("longitude"), F.lit(0.0).alias("latitude"), F.lit(100.0).alias("dist_buffer")
    )
    text = plan(hexjoin.hex_join(spots, grid, ["id"]))
    assert text.count("Join") == 1 and "NestedLoop" not in text and "Cartesian" not in text
