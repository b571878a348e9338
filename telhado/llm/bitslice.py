"""Exact top-k by integer inner product over a bit-sliced index.

A block of candidates holds, for each component and each bit of its quantised value, a bitmap over
the block's rows. For a query the bitmaps that its own bits select are added up by carry-save
adders, which leaves one bitmap for each bit of the score. The best rows are then chosen from the
most significant slice downward; rows that tie at the border are resolved by their exact order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from telhado.session import materialise

SCALE = 1024
TOP = 10
LARGEST = (1 << 62) - 1
QUERY_EVERY = 100
# Rows of a block of candidates and of a block of queries, on average.
BLOCK_ROWS = 8192
QUERY_ROWS = 8192


def quantised(embedding: Column, scale: int = SCALE) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _pack(bits: np.ndarray) -> np.ndarray:
    """Bitmaps (..., rows) as words of 64 bits; rows beyond the last are 0."""
    rows = bits.shape[-1]
    padded = np.zeros((*bits.shape[:-1], -(-rows // 64) * 64), np.uint8)
    padded[..., :rows] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


class SlicedBlock:
    """The index of one block of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, vectors, self.copies = ids[order], vectors[order], copies[order]
        self.low = int(vectors.min()) if vectors.size else 0
        high = int(vectors.max()) if vectors.size else 0
        self.bits = max(1, (high - self.low).bit_length())
        shifted = (vectors - self.low).astype(np.uint64).T
        self.rows = len(ids)
        self.valid = _pack(np.ones(self.rows, np.uint8))
        # (component, bit, words), and the complement for negative factors.
        self.slices = np.stack(
            [_pack(((shifted >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(self.bits)], axis=1
        )
        self.negated = ~self.slices & self.valid
        self.reach = max(abs(self.low), abs(high))

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """(bitmaps of the score's bits, least first; constant to add) for a quantised query."""
        size = np.abs(query)
        if sum(size.tolist()) * 2 * self.reach > LARGEST:
            raise OverflowError("inner products of these vectors leave 64 bits")
        top = (1 << self.bits) - 1
        constant = self.low * int(query.sum()) - top * int(size[query < 0].sum())
        levels: dict[int, list[np.ndarray]] = {}
        for i in range(int(size.max()).bit_length() if len(size) else 0):
            chosen = (size >> i) & 1 == 1
            maps = np.concatenate([self.slices[chosen & (query > 0)], self.negated[chosen & (query < 0)]])
            for j in range(self.bits):
                if len(maps):
                    levels.setdefault(i + j, []).append(maps[:, j])
        out: list[np.ndarray] = []
        level = 0
        while level <= max(levels, default=-1):
            stack = np.concatenate(levels.pop(level)) if level in levels else np.empty((0, len(self.valid)), np.uint64)
            while len(stack) > 1:
                # Full adders: three bitmaps of a weight leave one, and one of twice the weight.
                thirds = len(stack) // 3
                if thirds:
                    a, b, c = stack[:thirds], stack[thirds : 2 * thirds], stack[2 * thirds : 3 * thirds]
                    half = a ^ b
                    carry, rest = (a & b) | (half & c), np.concatenate([half ^ c, stack[3 * thirds :]])
                else:
                    carry, rest = (stack[:1] & stack[1:2]), stack[:1] ^ stack[1:2]
                levels.setdefault(level + 1, []).append(carry)
                stack = rest
            out.append(stack[0] if len(stack) else np.zeros_like(self.valid))
            level += 1
        return out, constant

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, scores, copies) of the k best rows other than the query's own, ties to smaller ids."""
        sums, constant = self.scores(query)
        left, right = np.searchsorted(self.ids, [query_id, query_id + 1])
        own = np.zeros(self.rows, np.uint8)
        own[left:right] = 1
        open_, sure = self.valid & ~_pack(own), np.zeros_like(self.valid)
        need = k
        for bitmap in reversed(sums):
            with_bit = open_ & bitmap
            held = int(np.bitwise_count(with_bit).sum())
            if held > need:
                open_ = with_bit
            else:
                sure |= with_bit
                need -= held
                open_ = open_ & ~bitmap
                if not need:
                    break
        rows = self._rows(sure)
        if need:
            # What is still open ties at the border; rows are in order of their ids.
            rows = np.concatenate([rows, self._rows(open_)[:need]])
        word, bit = rows // 64, (rows % 64).astype(np.uint64)
        score = np.full(len(rows), constant, np.int64)
        for place, bitmap in enumerate(sums):
            score += ((bitmap[word] >> bit) & np.uint64(1)).astype(np.int64) << place
        return self.ids[rows], score, self.copies[rows]

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _search(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(candidates) and len(queries):
            width = max(candidates["v"].map(len).max(), queries["v"].map(len).max())
            block = SlicedBlock(
                candidates["vec_id"].to_numpy(np.int64), _matrix(candidates["v"], width), candidates["copies"].to_numpy(np.int64)
            )
            for query_id, query in zip(queries["vec_id"].to_numpy(np.int64), _matrix(queries["v"], width)):
                ids, score, copies = block.top(int(query_id), query, k)
                parts.append((np.full(len(ids), query_id), ids, score, copies))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 4
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score", "copies"), columns)))

    return run


def top_k(
    vectors: DataFrame, k: int = TOP, query_every: int = QUERY_EVERY, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose vec_id is divisible by `query_every` its k best others.

    `vectors` has vec_id and embedding. Scores are inner products of the quantised components, exact;
    vectors so large that one may leave 64 bits are an error. A shorter vector counts as filled up with zeros. Rows whose vec_id is null, or whose
    vector is null or holds a null or non-finite component, take no part; a repeated id stands for
    all its rows, none of which is its own candidate. Blocks of candidates meet blocks of queries, both of bounded
    size whatever ids repeat, and each pair of blocks gives at most k rows for a query. Equal rows are one candidate that
    counts its copies, told again after the choice. An empty table gives no rows.
    """
    usable = materialise(
        vectors.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
        .select("vec_id", quantised(F.col("embedding")).alias("v"))
        .groupBy("vec_id", "v")
        .agg(F.count("*").alias("copies")),
        "quantised",
    )
    is_query = F.col("vec_id") % query_every == 0
    rows, asked = usable.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, groups = max(1, -(-rows // block_rows)), max(1, -(-asked // query_rows))
    spread = F.xxhash64("vec_id", "v")
    candidates = usable.select(
        F.pmod(spread, F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        "vec_id",
        "v",
        "copies",
    )
    queries = usable.where(is_query).select(
        F.pmod(spread, F.lit(groups)).cast("int").alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "vec_id",
        "v",
    )
    best = (
        candidates.groupBy("block", "group")
        .cogroup(queries.groupBy("block", "group"))
        .applyInPandas(_search(k), "query_id long, vec_id long, score long, copies long")
    )
    # A query has at most k rows from each block, each at most k times.
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
