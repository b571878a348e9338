"""Token counts of whole texts, huge ones by overlapping chunks.

A huge text is encoded in chunks that overlap. Within an overlap both encodings are looked at: they
are spliced where a space or line break follows another character, because nothing that decides the
tokens on one side of such a place lies on the other (normalisation, special strings and
pre-tokens end there), and only if both encodings give the same tokens from the first to
the last such place of the overlap. Where there is none, or they differ, the overlap is widened,
up to whole chunks and then to chunks twice as long each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import Apart, arrow_map, split_words

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
LIMIT = 2048
MEMO = 1_500_000
MEMO_CHARS = 64
_BREAKS = " \n\t\r"

# Tokens of a stretch of text: (id, start, end), places counted in characters.
Encode = Callable[[str], list[tuple[int, int, int]]]


def _places(text: str, lo: int, hi: int) -> list[int]:
    """Places p in (lo, hi) at which white space follows another character."""
    return [p for p in range(lo + 1, hi) if text[p] in _BREAKS and not text[p - 1].isspace()]


def _between(tokens: list[tuple[int, int, int]], lo: int, hi: int) -> list[tuple[int, int, int]]:
    return [t for t in tokens if lo <= t[1] < hi]


def spliced_count(text: str, encode: Encode, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Number of tokens of the whole text, from encodings of overlapping chunks."""

    def encoded(lo: int, hi: int) -> list[tuple[int, int, int]]:
        return [(i, a + lo, b + lo) for i, a, b in encode(text[lo:hi])]

    total = done = 0
    start, end = 0, min(len(text), chunk)
    left = encoded(start, end)
    while end < len(text):
        width = min(overlap, end - start)
        while True:
            begin = end - width
            stop = min(len(text), begin + max(chunk, 2 * width))
            places = _places(text, max(begin, done), end)
            if places:
                right = encoded(begin, stop)
                first, last = places[0], places[-1]
                if _between(left, first, last) == _between(right, first, last):
                    break
            if width == end - start:
                # Nothing in the whole chunk can be relied on: take one twice as long.
                end = min(len(text), start + 2 * (end - start))
                left = encoded(start, end)
                if end == len(text):
                    return total + len(_between(left, done, len(text) + 1))
                width = min(overlap, end - start)
            else:
                width = min(2 * width, end - start)
        total += len(_between(left, done, first))
        done, start, end, left = first, begin, stop, right
    return total + len(_between(left, done, len(text) + 1))


def count(docs: DataFrame, definition: str, limit: int = LIMIT, chunk: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of `docs` from its whole text.

    Counts are those the tokenizers library gives for the whole text without added special tokens.
    A null text counts as empty; repeated rows stay repeated.
    """
    held = docs.sparkSession.sparkContext.broadcast({"definition": definition})

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        store = held.value
        if "tokenizer" not in store:
            store["tokenizer"] = Tokenizer.from_str(store["definition"])
            store["apart"] = Apart(store["tokenizer"])
        tokenizer = store["tokenizer"]

        def encode(text: str) -> list[tuple[int, int, int]]:
            found = tokenizer.encode(text, add_special_tokens=False)
            return [(i, *span) for i, span in zip(found.ids, found.offsets)]

        memo = store.setdefault("memo", {})

        def word_sizes(words: list[str]) -> np.ndarray:
            sizes = list(map(memo.get, words))
            new = [i for i, n in enumerate(sizes) if n is None]
            if len(memo) + len(new) > MEMO:
                memo.clear()
            for i, ids in zip(new, store["apart"].encode([words[i] for i in new], np.uint32)):
                sizes[i] = len(ids) // 4
                if len(words[i]) <= MEMO_CHARS:
                    memo[words[i]] = sizes[i]
            return np.array(sizes, np.int64)

        for batch in columns:
            if not len(batch["text"]):
                continue
            text = pc.fill_null(batch["text"], "")
            huge = pc.greater(pc.utf8_length(text), chunk)
            short = pc.if_else(huge, "", text)
            for mark in "\n\t\r":
                short = pc.replace_substring(short, mark, " ")
            # The same places part a short text: its words are counted, each different one once.
            codes, offsets, words = split_words(short)
            tokens = np.add.reduceat(word_sizes(words)[codes], offsets[:-1])
            for i in np.flatnonzero(huge.to_numpy(zero_copy_only=False)):
                tokens[i] = spliced_count(text[int(i)].as_py(), encode, chunk)
            yield {
                "doc_id": batch["doc_id"],
                "n_bytes": pc.fill_null(pc.binary_length(batch["text"]), 0).cast(pa.int64()),
                "n_tokens": pa.array(tokens, pa.int64()),
                "over_limit": pa.array(tokens > limit, pa.bool_()),
            }

    return arrow_map(
        docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
