"""Circles as text: by the array and corner by corner."""

from pyspark.sql import functions as F

from telhado.functions import circles, geodesy


def one_by_one(points):
    centre = geodesy.utm_xy(F.col("longitude"), F.col("latitude"))
    ring = geodesy.circle_ring(F.col("c"), F.col("dist_buffer"))
    text = F.array_join(F.transform(ring, lambda p: geodesy.coordinate_text(p["longitude"], p["latitude"])), ", ")
    return points.withColumn("c", centre).select("id", F.concat(F.lit("POLYGON (("), text, F.lit("))")).alias("buffer_wkt"))


def test_text_by_the_array_is_that_of_single_corners(spark):
    rows = [(i, -41.9 + i * 0.0173 % 2.2, -21.3 + i * 0.0311 % 3.4, (100.0, 1000.0, 0.0, 37.25)[i % 4]) for i in range(300)]
    # Missing values, coordinates written with an exponent or as whole numbers, a centre far off the zone.
    rows += [(300, None, -20.0, 100.0), (301, -40.0, -20.0, None), (302, 0.0, 0.0, 100.0), (303, -39.0, 0.0, 0.0), (304, float("nan"), 1.0, 5.0)]
    points = spark.createDataFrame(rows, "id int, longitude double, latitude double, dist_buffer double")
    got = geodesy.with_buffer_wkt(points).select("id", "buffer_wkt")
    assert dict(got.collect()) == dict(one_by_one(points).collect())


def test_nearly_all_circles_are_written_by_the_array():
    import pyarrow as pa

    scale = geodesy.UTM_SCALE * geodesy.RECTIFYING_RADIUS
    text = circles.circle_text(30, scale, 5e5, 1e7, geodesy.BETA, geodesy.LATITUDE, -39.0, 6)
    spots = pa.array([2e5 + 101.7 * i for i in range(2000)]), pa.array([7.6e6 + 211.3 * i for i in range(2000)])
    assert text(*spots, pa.array([100.0] * 2000)).null_count < 20


def test_few_input_tasks_are_spread_over_all(spark):
    """A scan of few row groups must not leave the corners of all circles to one task."""
    points = spark.range(2000).coalesce(1).selectExpr("id", "-41.0 + id / 1e5 AS longitude", "-20.0D AS latitude", "100.0D AS dist_buffer")
    frame = geodesy.with_buffer_wkt(points)
    spread = [r["n"] for r in frame.groupBy(F.spark_partition_id()).agg(F.count("buffer_wkt").alias("n")).collect()]
    assert len(spread) >= 8 and max(spread) <= 2 * 2000 / 8
