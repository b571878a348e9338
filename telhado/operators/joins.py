"""Join helpers: NULL-matching keys, and lookups that stand hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SALT = "__salt"
SALT_BYTES = 64 * 1024 * 1024
# Compressed files and exploded arrays hold several times the bytes the planner sees.
SIZE_MARGIN = 8
# Keys told to be hot at most: more cannot each hold a large part of a partition in a thousand.
MOST_HOT = 2000
WAYS = 16


def planned_bytes(df: DataFrame) -> int:
    """Planner's upper estimate of the size of `df`."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    """The session's own broadcast limit in bytes (-1 switches broadcasting off)."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def left_join_nullsafe(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which a NULL key matches a NULL key; planned as an equi-join."""
    hidden = f"__{key}"
    renamed = right.withColumnRenamed(key, hidden)
    return left.join(renamed, left[key].eqNullSafe(renamed[hidden]), "left").drop(hidden)


def salt_count(right: DataFrame) -> int:
    """Ways to split each key: as many as shuffle partitions, while copying `right` that often stays cheap.

    The copies may add SALT_BYTES to each shuffle partition.
    """
    partitions = int(right.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    affordable = partitions * SALT_BYTES // max(planned_bytes(right), 1)
    return max(2, min(partitions, affordable))


def salted_left_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str | Column], salts: int | None = None
) -> DataFrame:
    """Left join to a `right` unique on `keys`, with every key of `left` split `salts` ways.

    The salt is a hash of `spread_by`, so a retried task sends each row to the same place.
    """
    salts = salts or salt_count(right)
    cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in spread_by]
    salted = left.withColumn(SALT, F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int"))
    copies = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # The planner sees the size of one copy and would broadcast them all.
    return salted.join(copies.hint("merge"), [*keys, SALT], "left").drop(SALT)


def heavy_hitters(left: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys that may hold half of what a shuffle partition holds on average.

    One pass over the key columns with Spark's own frequent-items sketch, which never misses such a
    key: it tracks many times more items than there can be. At most MOST_HOT numbers reach the driver.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(2 * partitions, MOST_HOT)
    named = left.where(~_no_key(keys)).select(key_hash(keys).alias("h"))
    tracked = F.expr(f"approx_top_k(h, {wanted}, {max(1024, 16 * wanted)})")
    found = named.agg(tracked.alias("top"), F.count(F.lit(1)).alias("n")).head()
    return [row["item"] for row in found["top"] or [] if row["count"] * 2 * partitions >= found["n"]]


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _no_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])


def hot_salted(
    left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str | Column], hot: list[int], salts: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: rows of a hot key are split `salts` ways, all others keep salt 0.

    Only the right rows of hot keys are copied, so the right side hardly grows. Rows with a NULL key
    match nothing and are split as well.
    """
    # More ways than partitions, so that the parts fall evenly.
    salts = salts or WAYS * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in spread_by]
    is_hot = key_hash(keys).isin(hot) if hot else F.lit(False)
    spread = left.withColumn(SALT, F.when(is_hot | _no_key(keys), F.pmod(F.xxhash64(*cols), F.lit(salts))).otherwise(0).cast("int"))
    ways = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return spread, right.withColumn(SALT, F.explode(ways))


def lookup_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str | Column], row_bytes: Column | int | None = None,
    hot_only: bool = False,
) -> DataFrame:
    """Left join of many rows to a reference table unique on `keys`.

    Broadcasts `right` only when the planner's size for it, times SIZE_MARGIN, is under the
    session's broadcast limit; otherwise joins by shuffle with the keys of `left` salted. For rows
    whose size the planner cannot know, `row_bytes` says what each takes, and is summed up; a number
    is a bound on them all. With
    `hot_only` one more pass over the keys of `left` finds the frequent ones, and only those are salted:
    for a `left` that is cheap to read and a `right` too large to copy.
    """
    if row_bytes is None:
        size = planned_bytes(right) * SIZE_MARGIN
    elif isinstance(row_bytes, int):
        size = row_bytes
    else:
        size = right.agg(F.sum(row_bytes)).head()[0] or 0
    if size <= broadcast_limit(right):
        return left.join(F.broadcast(right), keys, "left")
    if hot_only:
        spread, copies = hot_salted(left, right, keys, spread_by, heavy_hitters(left, keys))
        return spread.join(copies.hint("merge"), [*keys, SALT], "left").drop(SALT)
    return salted_left_join(left, right, keys, spread_by)


def refuse_columns(df: DataFrame, names: set[str]) -> None:
    """Stop if `df` already has a column that the caller is about to add for its own use."""
    taken = names & set(df.columns)
    if taken:
        raise ValueError(f"columns with names in use: {sorted(taken)}")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column absent from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
