"""Lookups by keys of which one holds a third of the rows."""

from statistics import median

from pyspark.sql import functions as F

from telhado.operators import joins

ROWS, WIDE = 120_000, 30_000


def sides(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % WIDE))
    left = spark.range(0, ROWS, 1, 8).select("id", key.alias("k"), (F.col("id") % 2).alias("m"))
    right = spark.range(WIDE).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("w"))
    return left, right.unionByName(spark.range(1).select(F.lit("hot").alias("k"), F.lit(-1).cast("long").alias("w")))


def test_only_hot_keys_are_found_and_copied(spark):
    left, right = sides(spark)
    hot = joins.heavy_hitters(left, ["k"])
    assert hot == [spark.range(1).select(F.xxhash64(F.lit("hot"))).head()[0]]
    spread, copies = joins.hot_salted(left, right, ["k"], ["id"], hot, 8)
    assert copies.count() == WIDE + 8 < 2 * right.count()
    assert spread.where("k = 'hot'").select(joins.SALT).distinct().count() == 8
    assert spread.where("k <> 'hot'").agg(F.max(joins.SALT)).head()[0] == 0
    assert spread.where("k IS NULL").select(joins.SALT).distinct().count() == 8


def test_joined_rows_are_right_and_even(spark, shuffled_joins):
    left, right = sides(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.lookup_join(left, right, ["k"], ["id"], hot_only=True)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(per_task) < 2 * median(per_task)
        plain = left.join(right, "k", "left")
        assert joined.columns == plain.columns
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_hot_key_and_no_rows(spark, shuffled_joins):
    left, right = sides(spark)
    even = left.where("k <> 'hot'")
    assert joins.heavy_hitters(even, ["k", "m"]) == [] == joins.heavy_hitters(left.limit(0), ["k"])
    assert joins.lookup_join(even, right, ["k"], ["id"], hot_only=True).where("w IS NULL").isEmpty()
    assert joins.lookup_join(left.limit(0), right, ["k"], ["id"], hot_only=True).isEmpty()
