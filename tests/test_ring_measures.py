"""Text of rings read back and measured."""

import math

from pyspark.sql import functions as F

from telhado.functions import geodesy
from telhado.suite.queries_geo import ring_texts


def test_rings_of_any_length_are_measured(spark):
    square = "-39.0 -20.0, -39.0 -19.99, -38.99 -19.99, -38.99 -20.0, -39.0 -20.0"
    rows = [(0, f"POLYGON (({square}))"), (1, f"POLYGON (({square}), (-39.0 -20.0, -38.99 -19.99))"), (2, "none"), (3, "((-39.0 -20.0))")]
    texts = spark.createDataFrame(rows, "id int, wkt string").withColumn("o", geodesy.utm_xy(F.lit(-39.0), F.lit(-20.0)))
    rings = texts.select("id", "o", F.explode(ring_texts(F.col("wkt"))).alias("ring"))
    got = sorted(rings.select("id", geodesy.ring_measures(F.col("ring"), F.col("o")).alias("m")).select("id", "m.*").collect())
    assert [(r["id"], r["sides"], r["closed"]) for r in got] == [(0, 4, True), (1, 1, False), (1, 4, True), (3, 0, True)]
    side = math.radians(0.01) * 6378137.0
    assert abs(abs(got[0]["doubled"]) / 2 / (side * side * math.cos(math.radians(20))) - 1) < 0.01
    assert (got[0]["low_longitude"], got[0]["high_latitude"]) == (-39.0, -19.99)
