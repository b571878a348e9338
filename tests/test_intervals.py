"""Values and irregular intervals against every pair."""

import random
from collections import Counter

import pytest

from telhado.operators import intervals


def given(seed):
    rng = random.Random(seed)
    bands = [(i, lo, lo + rng.choice([0.0, 0.5, 3.0, 40.0, 5000.0])) for i, lo in enumerate(rng.uniform(-500, 500) for _ in range(150))]
    bands += [(900, 1.0, 1.0), (901, -1e10, 1e10), (902, 5.0, 4.0), (903, None, 4.0), (904, 4.0, float("nan")), (905, 0.0, float("inf"))]
    bands += [(906, 1.0, 1.0), (None, 64.0, 128.0)]
    values = [rng.choice([rng.uniform(-600, 600), 1.0, 64.0, 128.0]) for _ in range(800)]
    values += [b[1] for b in bands if b[1] is not None] + [b[2] for b in bands if b[2] == b[2]] + [None, float("nan"), float("inf"), 1e300]
    return bands, values


@pytest.mark.parametrize("broadcast", [True, False])
def test_every_pair(spark, broadcast):
    bands, values = given(4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit if broadcast else "-1")
    try:
        table = spark.createDataFrame(bands, "band int, low double, high double")
        rows = spark.createDataFrame(list(enumerate(values)), "id int, v double")
        sound = [b for b in bands if b[1] is not None and abs(b[2]) < float("inf") and b[1] <= b[2]]
        want = Counter((i, b[0]) for i, v in enumerate(values) if v is not None and abs(v) < float("inf") for b in sound if b[1] <= v <= b[2])
        got = Counter((r["id"], r["band"]) for r in intervals.interval_join(rows, table, "v").collect())
        assert got == want
        per_band = Counter()
        for (_, band), n in want.items():
            per_band[band] += n
        counted = intervals.count_by_interval(rows, table, "v").collect()
        assert len(counted) == len(bands)
        assert {r["band"]: r["n_rows"] for r in counted} == {b[0]: per_band[b[0]] for b in bands}
        assert intervals.interval_join(rows, table.limit(0), "v").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_cell_holds_few_intervals(spark):
    """Narrow intervals next to a very wide one: each value meets a handful of candidates."""
    table = spark.range(20_000).selectExpr("CAST(id AS DOUBLE) AS low", "id + 0.9 AS high").unionByName(spark.sql("SELECT 0D AS low, 1e9 AS high"))
    index = intervals.indexed(table, "low", "high")
    assert index.count() <= 2 * 20_001
    assert index.groupBy(*intervals.CELL).count().agg({"count": "max"}).head()[0] <= 3
