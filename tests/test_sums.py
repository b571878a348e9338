"""Sums of doubles in any order, next to exact fractions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from telhado.functions.sums import exact_mean, exact_sum
from telhado.operators import indicators as ind


def bits(df):
    return sorted(tuple(v.hex() if isinstance(v, float) else v for v in row) for row in df.collect())


def test_same_bits_under_any_partitioning(spark):
    rnd = random.Random(3)
    rows = [(i % 3, rnd.choice([1e15, 1e9, 1.0, 1e-3]) * rnd.uniform(-1, 1)) for i in range(6000)]
    found = set()
    for n in (1, 8, 200):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, x double").repartition(n)
        out = df.groupBy("k").agg(exact_sum(F.col("x")).alias("s"), exact_mean(F.col("x")).alias("m"))
        found.add(str(bits(out)))
        got = {r["k"]: r["s"] for r in out.collect()}
    assert len(found) == 1
    for k in range(3):
        exact = sum(Fraction(x) for key, x in rows if key == k)
        assert abs(Fraction(got[k]) - exact) <= abs(exact) * Fraction(1, 2**50) + Fraction(2000, 2**52)


def test_indicators_have_the_same_bits(spark):
    rnd = random.Random(4)
    rows = [(f"m{i % 2}", rnd.randrange(1, 10**7) / 10, rnd.randrange(100, 5000) / 10, float(i % 4 + 1)) for i in range(3000)]
    price = ind.PRICE
    found = set()
    for n in (1, 8, 200):
        rnd.shuffle(rows)
        ads = spark.createDataFrame(rows, ["munic", price, "area_m2", "n_quartos"]).repartition(n)
        labels = ["1_quarto", "2_quartos", "3_quartos", "4_quartos"]
        whole = bits(ind.indicators(ads, "munic", labels))
        assert whole == bits(ind.indicators_by_join(ads, "munic", labels))
        found.add(str(whole))
    assert len(found) == 1


def test_small_negative_values_keep_their_digits(spark):
    got = spark.createDataFrame([(-0.1,)], "x double").agg(exact_sum(F.col("x")).alias("s")).head()["s"]
    assert abs(got + 0.1) <= 2.0**-52


def test_values_without_digits(spark):
    rows = [(1, None), (2, math.inf), (2, 1.0), (3, math.nan), (4, 1e300), (4, 0.5), (5, -0.25), (5, None), (6, 2.0**53 - 1), (6, -1e-20)]
    df = spark.createDataFrame(rows, "k int, x double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum(F.col("x")).alias("s")).collect()}
    assert got[1] is None and got[2] == math.inf and math.isnan(got[3])
    assert (got[4], got[5], got[6]) == (1e300, -0.25, 2.0**53 - 1)
    means = df.filter("k < 2 OR k = 5").groupBy("k").agg(exact_mean(F.col("x")).alias("m")).collect()
    assert {r["k"]: r["m"] for r in means} == {1: None, 5: -0.25}
    assert df.limit(0).agg(exact_sum(F.col("x")).alias("s")).head()["s"] is None
