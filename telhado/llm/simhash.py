"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint of 64 bits is eight bytes at eight positions. Two fingerprints that differ in at most
three bits share at least five positional bytes. Postings are kept for groups of positions, such
that any five positions hold one of the groups; a pair that meets in a posting has its shared
positional bytes counted, is retained from five on, and is then verified on the bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from telhado.session import materialise

from .common import arrow_map, free_names, utf8
from .graph import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
POSITIONS = 8
MIN_SHARED = POSITIONS - MAX_BITS
# Any five of eight positions have three within the lower or within the upper half.
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
FIVES = list(combinations(range(POSITIONS), MIN_SHARED))
# A posting of more fingerprints than this is split by two further positions, and one that is
# still longer is linked through hubs (see `_hub_links`); no link is lost either way.
LONG_POSTING = 256
BLOCK = 1 << 16

# Number of ones at each bit of each byte value: (256, 8), bit 0 first.
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text given as UTF-8, as a signed 64-bit integer."""
    words = text.lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    counts = np.zeros(256 * POSITIONS, np.int64)
    offsets = np.arange(POSITIONS) * 256
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK], ends[at : at + BLOCK])
        hashes = np.array([digest(whole[s:e], SEED) for s, e in spans], "<u8")
        cells = hashes.view(np.uint8).reshape(-1, POSITIONS) + offsets
        counts += np.bincount(cells.ravel(), minlength=256 * POSITIONS)
    ones = (counts.reshape(POSITIONS, 256) @ _BITS).ravel()
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    for batch in columns:
        prints = [fingerprint(t) for t in utf8(batch["text"])]
        yield {"doc_id": batch["doc_id"], "fp": pa.array(prints, pa.int64())}


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row of `docs` from its whole text; null and empty texts have fp 0."""
    return arrow_map(docs.select("doc_id", "text"), _fingerprints, "doc_id long, fp long")


def byte_at(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(0xFF))


def positional_key(fp: Column, number: int, positions: tuple[int, ...]) -> Column:
    """The bytes at `positions` and the number of the group of positions, in one integer."""
    mask = sum(0xFF << (8 * p) for p in positions)
    return F.struct(F.lit(number).alias("g"), fp.bitwiseAND(F.lit(_signed(mask))).alias("bytes"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shared_bytes(a: Column, b: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    differ = a.bitwiseXOR(b)
    return sum(F.when(byte_at(differ, p) == 0, 1).otherwise(0) for p in range(POSITIONS))


def _sized(postings: DataFrame) -> DataFrame:
    """Postings of at least two fingerprints, with their number."""
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return postings.join(sizes, "key")


def _pair_links(postings: DataFrame) -> DataFrame:
    """Links within postings of at most LONG_POSTING fingerprints: tally shared bytes, then verify the bits."""
    lists = postings.groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    each = lists.select("fps", F.explode("fps").alias("a"))
    near = F.filter(
        "fps",
        lambda x: (x < F.col("a"))
        & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= MAX_BITS)
        & (shared_bytes(x, F.col("a")) >= MIN_SHARED),
    )
    return each.select("a", F.explode(near).alias("b"))


def _flips() -> list[tuple[int, list[int]]]:
    """For each group of five positions, the masks that flip at most two bits of the other three bytes."""
    out = []
    for number, five in enumerate(FIVES):
        bits = [8 * p + i for p in range(POSITIONS) if p not in five for i in range(8)]
        masks = [0, *(1 << b for b in bits), *((1 << b) | (1 << c) for b, c in combinations(bits, 2))]
        out.append((number, [_signed(m) for m in masks]))
    return out


def _hub_links(postings: DataFrame) -> DataFrame:
    """Links that connect what is within three bits inside very long postings, without their pairs.

    Every fingerprint names the values at most two bits away, within the bytes in which its
    posting can still differ. If one of those that named a value is at most one bit from it, all
    that named it are within three bits of that one, and are linked to it. Two fingerprints three
    bits apart always meet so: at one bit from the one and two from the other. At most 301 can
    name a value through one group of positions, so a group here is bounded.
    """
    spark = postings.sparkSession
    flips = spark.createDataFrame(_flips(), "g int, masks array<long>")
    named = (
        postings.select("fp", F.col("key.g").alias("g"))
        .join(F.broadcast(flips), "g")
        .select("fp", F.explode("masks").alias("mask"))
        .select(F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), "fp", F.bit_count("mask").alias("bits"))
    )
    hubs = named.where("bits <= 1").groupBy("value").agg(F.min("fp").alias("hub"))
    return named.join(hubs, "value").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def links(distinct: DataFrame, long_posting: int = LONG_POSTING) -> DataFrame:
    """(a, b) links between distinct fingerprints (column fp) that connect all within three bits of each other.

    Every link joins fingerprints at most three bits apart, and any two so near are connected.
    """
    triples = F.array(*(positional_key(F.col("fp"), i, t) for i, t in enumerate(TRIPLES)))
    sized = materialise(_sized(distinct.select("fp", F.explode(triples).alias("key"))), "postings")
    # The five-position groups that refine a group of three.
    finer = [[i for i, five in enumerate(FIVES) if set(t) <= set(five)] for t in TRIPLES]
    long = sized.where(F.col("n") > long_posting)
    fives = [positional_key(F.col("fp"), i, five) for i, five in enumerate(FIVES)]
    refined = F.element_at(
        F.create_map(*(x for i, own in enumerate(finer) for x in (F.lit(i), F.array(*(F.lit(j) for j in own))))),
        F.col("key.g"),
    )
    split = (
        long.select("fp", F.explode(refined).alias("g"))
        .distinct()
        .select("fp", F.element_at(F.array(*fives), F.col("g") + 1).alias("key"))
    )
    split = materialise(_sized(split), "postings")
    return (
        _pair_links(sized.where(F.col("n") <= long_posting))
        .unionByName(_pair_links(split.where(F.col("n") <= long_posting)))
        .unionByName(_hub_links(split.where(F.col("n") > long_posting)))
    )


def classes(prints: DataFrame, long_posting: int = LONG_POSTING) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of `prints` (doc_id, fp).

    `root` names the component, `component_id` is its smallest doc_id (null only where all its
    ids are null). Copies share a fingerprint, so they meet in an aggregate and not in pairs.
    """
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = materialise(components(links(distinct.select("fp"), long_posting)).withColumnRenamed("node", "fp"), "roots")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, long_posting: int = LONG_POSTING) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs` (doc_id, text, any others).

    Repeated rows stay repeated; null texts count as empty, and all empty texts are linked. A null
    id keeps its row and gets the smallest id its component has. An empty table gives no rows.
    """
    prints = materialise(fingerprints(docs), "prints")
    return prints.join(classes(prints, long_posting), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, long_posting: int = LONG_POSTING) -> DataFrame:
    """The rows of `docs` without near copies: of each component the row with the smallest doc_id stays.

    All columns of `docs` are kept whatever their names. Of rows that agree in id and fingerprint
    one stays. Ids that are null come last; an empty table stays empty.
    """
    own, keep, keep_print = free_names(docs, "__fp", "__keep", "__keep_fp")
    prints_udf = F.pandas_udf(_series_prints, "long")
    marked = materialise(docs.withColumn(own, prints_udf(F.col("text").cast("binary"))), "marked")
    prints = marked.select("doc_id", F.col(own).alias("fp"))
    chosen = (
        prints.join(classes(prints, long_posting), "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("first"))
        .select(F.col("first.doc_id").alias(keep), F.col("first.fp").alias(keep_print))
    )
    kept = marked.join(
        chosen, F.col("doc_id").eqNullSafe(F.col(keep)) & (F.col(own) == F.col(keep_print)), "left_semi"
    )
    return kept.dropDuplicates(["doc_id", own]).select(*(F.col(f"`{c}`") for c in docs.columns))


def _series_prints(values: pd.Series) -> pd.Series:
    return values.map(lambda v: fingerprint(v or b""))
