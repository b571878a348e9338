"""Benchmark decontamination by spaced seeds.

A mask looks at some words of a window and ignores the others, so a substituted word at an ignored
place does not hide a copy. Masked windows of benchmark and documents are hashed and joined; around
each hit the two are laid side by side and their words compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from telhado.operators.joins import lookup_join
from telhado.session import materialise

from .common import arrow_map, free_names, texts

# A leak is a run of this many words (or a whole shorter item) of which this share agrees.
RUN = 13
SHARE = 0.8
# Wherever two of 13 words are substituted, one of these masks has a window that misses both.
MASKS = ((0, 1, 2, 4, 5, 8), (0, 1, 5, 6, 7, 8))
FILTER_BITS = 24
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) & 0xFFFFFFFFFFFFFFFF | 1 for i in range(64)], np.uint64)
_SPLIT = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()), b" " * (128 - 62))


def words_of(text: str) -> list[bytes]:
    """Lower-case words; every ASCII character but letters and digits parts them."""
    return text.lower().encode("utf-8", "replace").translate(_SPLIT).split()


def word_hashes(text: str) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words_of(text)], np.uint64)


def masks_for(n_words: int) -> tuple[tuple[int, ...], ...]:
    """The masks by which an item of so many words is found.

    An item shorter than RUN may have k substitutions; of k + 1 blocks of it, one has none.
    """
    if n_words >= RUN:
        return MASKS
    allowed = n_words - int(np.ceil(SHARE * n_words - 1e-9))
    block = n_words // (allowed + 1)
    return (tuple(range(block)),) if block else ()


def seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of each window of the words under the mask; the mask itself is part of the hash."""
    count = len(hashes) - mask[-1]
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, sum(1 << o for o in mask), np.uint64) * _ODD[0]
    for place, offset in enumerate(mask, 1):
        total += hashes[offset : offset + count] * _ODD[place]
    return (total ^ (total >> np.uint64(29))) * _ODD[40] ^ (total >> np.uint64(32))


def _item_rows(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    for batch in columns:
        words, found = [], []
        for text in texts(batch["text"]):
            h = word_hashes(text)
            words.append(h.view(np.int64).tolist())
            own = []
            for mask in masks_for(len(h)):
                own += [{"seed": int(s), "q": q} for q, s in enumerate(seeds(h, mask).view(np.int64))]
            found.append(own)
        yield {
            "item": batch["item"],
            "words": pa.array(words, pa.list_(pa.int64())),
            "seeds": pa.array(found, pa.list_(pa.struct([("seed", pa.int64()), ("q", pa.int32())]))),
        }


def _cells(hashes: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return [((hashes >> np.uint64(s)) & mask).astype(np.int64) for s in (0, 20, 40)]


def _bitmap(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    flags = np.zeros(1 << FILTER_BITS, np.bool_)
    for batch in columns:
        for cells in _cells(batch["seed"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)):
            flags[cells] = True
    yield {"bitmap": pa.array([np.packbits(flags).tobytes()], pa.binary())}


def _search(bitmap: bytes, masks: list[tuple[int, ...]], reach: int):
    """Function of documents to their stretches with hits: the words around them and the hits' places and seeds."""

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        flags = np.unpackbits(np.frombuffer(bitmap, np.uint8)).view(np.bool_)
        for batch in columns:
            keys, starts, words, hits = [], [], [], []
            for key, text in zip(batch["key"].to_pylist(), texts(batch["text"])):
                h = word_hashes(text)
                places, found = [], []
                for mask in masks:
                    s = seeds(h, mask)
                    a, b, c = _cells(s)
                    at = np.flatnonzero(flags[a])
                    at = at[flags[b[at]] & flags[c[at]]]
                    places.append(at)
                    found.append(s[at])
                place = np.concatenate(places)
                if not len(place):
                    continue
                seed = np.concatenate(found).view(np.int64)
                order = np.argsort(place, kind="stable")
                place, seed = place[order], seed[order]
                for part in np.split(np.arange(len(place)), np.flatnonzero(np.diff(place) > 2 * reach) + 1):
                    first = max(0, int(place[part[0]]) - reach)
                    keys.append(key)
                    starts.append(first)
                    words.append(h[first : int(place[part[-1]]) + reach].view(np.int64).tolist())
                    hits.append([{"seed": int(seed[i]), "p": int(place[i])} for i in part])
            yield {
                "key": pa.array(keys, batch["key"].type),
                "start": pa.array(starts, pa.int32()),
                "words": pa.array(words, pa.list_(pa.int64())),
                "hits": pa.array(hits, pa.list_(pa.struct([("seed", pa.int64()), ("p", pa.int32())]))),
            }

    return run


def aligned(doc: np.ndarray, start: int, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(equal words, words laid side by side, place of the first) if some run of the item agrees, else None.

    `doc` holds the document's words from `start` on; word i of the item lies on word i + diagonal.
    """
    lo, hi = max(0, start - diagonal), min(len(item), start + len(doc) - diagonal)
    run = min(RUN, len(item))
    if run == 0 or hi - lo < run:
        return None
    same = doc[lo + diagonal - start : hi + diagonal - start] == item[lo:hi]
    total = np.concatenate(([0], np.cumsum(same)))
    if (total[run:] - total[:-run]).max() < np.ceil(SHARE * run - 1e-9):
        return None
    return int(total[-1]), hi - lo, lo + diagonal


def _verify(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    for batch in columns:
        rows = zip(*(batch[c].to_pylist() for c in ("key", "item", "start", "words", "item_words", "diagonal")))
        found = []
        for key, item, start, words, item_words, diagonal in rows:
            span = aligned(np.array(words, np.int64), start, np.array(item_words, np.int64), diagonal)
            if span:
                found.append((key, item, *span))
        columns_out = list(zip(*found)) or [()] * 5
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        names = ("key", "item", "equal_words", "n_words", "start_word")
        yield {n: pa.array(c, t) for n, c, t in zip(names, columns_out, types)}


def _matches(docs: DataFrame, benchmark: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """(leaks by `key`, items by their own key), each pair once with its best alignment."""
    items = benchmark.select("item_id", "text").distinct().withColumn("item", F.xxhash64("item_id", "text"))
    table = materialise(arrow_map(items.select("item", "text"), _item_rows, _ITEM), "items")
    seeds_table = table.select("item", F.explode("seeds").alias("s")).select("item", "s.seed", "s.q")
    sizes = [r[0] for r in table.select(F.least(F.size("words"), F.lit(RUN)).alias("n")).distinct().collect()]
    masks = sorted({m for n in sizes for m in masks_for(n)})
    reach = (table.agg(F.max(F.size("words"))).first()[0] or 0) + 1
    parts = arrow_map(seeds_table.select("seed").coalesce(8), _bitmap, "bitmap binary").collect()
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for part in parts:
        bits |= np.frombuffer(part["bitmap"], np.uint8)
    if not masks:
        masks = list(MASKS)
    stretches = arrow_map(
        docs.select(key.alias("key"), "text"),
        _search(bits.tobytes(), masks, reach),
        "key long, start int, words array<long>, hits array<struct<seed: long, p: int>>",
    )
    # Told apart by content, so that an id which repeats with another text, or is null, keeps all its stretches.
    stretches = materialise(stretches.withColumn("content", F.xxhash64("key", "words")), "stretches")
    by_seed = materialise(
        seeds_table.groupBy("seed").agg(F.collect_set(F.struct("item", "q")).alias("places")), "seeds"
    )
    hits = stretches.select("content", "start", F.explode("hits").alias("h")).select("content", "start", "h.seed", "h.p")
    pairs = (
        lookup_join(hits, by_seed, ["seed"], ["content", "p"])
        .select("content", "start", "p", F.explode("places").alias("place"))
        .select("content", "start", F.col("place.item").alias("item"), (F.col("p") - F.col("place.q")).alias("diagonal"))
        .distinct()
    )
    # Stretches of many copies are small as files and large as rows: never broadcast.
    around = stretches.select("content", "key", "start", "words").dropDuplicates(["content", "start"])
    laid = lookup_join(
        pairs.join(around.hint("merge"), ["content", "start"]),
        table.select("item", F.col("words").alias("item_words")),
        ["item"],
        ["content", "diagonal"],
    )
    found = arrow_map(laid.select("key", "item", "start", "words", "item_words", "diagonal"), _verify, _FOUND)
    best = found.groupBy("key", "item").agg(
        F.max(F.struct("equal_words", "n_words", (-F.col("start_word")).alias("start"))).alias("b")
    )
    return best.select("key", "item", "b.equal_words", "b.n_words", (-F.col("b.start")).alias("start_word")), items


_ITEM = "item long, words array<long>, seeds array<struct<seed: long, q: int>>"
_FOUND = "key long, item long, equal_words int, n_words int, start_word int"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, equal_words, n_words, start_word) for every document and benchmark item of which it holds a run.

    A run is RUN consecutive words of the item (all of a shorter one), of which at least SHARE
    stand at the same places in the document. The alignment with most equal words is told: how many
    of the n_words laid side by side are equal, and the document's word at which they begin. Rows
    that repeat an id give one row per item, the best of all their texts; a null id is one of its own. Null and
    empty texts and items without words never match.
    """
    found, items = _matches(docs, benchmark, F.col("doc_id"))
    return found.join(items.select("item", "item_id"), "item").select(
        F.col("key").alias("doc_id"), "item_id", "equal_words", "n_words", "start_word"
    )


def keep_unseen(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without any run of a benchmark item, with all their columns.

    Rows are told apart by text, so an id that repeats with another text is judged by its own. Rows
    without a text stay, and so do all rows where the benchmark is empty. Columns may have any names.
    """
    key = F.xxhash64("text")
    (mark,) = free_names(docs, "__dirty")
    found, _ = _matches(docs, benchmark, key)
    dirty = found.select(F.col("key").alias(mark)).distinct()
    return docs.join(materialise(dirty, "dirty"), key == F.col(mark), "left_anti")
