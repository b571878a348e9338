"""Token ids in flat binary files that can be memory-mapped.

Each partition of the documents, in order of doc_id, becomes three files: `.bin` holds the ids one
after the other as little-endian unsigned integers (16 bits where the vocabulary allows, else 32);
`.idx` holds, as unsigned 64-bit integers, where each document begins in it, and its end; `.ids`
holds the documents' ids as signed 64-bit integers. The manifest tells how many ids each partition
has, and how many documents at its start have no id; prefix sums of the former are the partitions' bases.
"""

from __future__ import annotations

import gc
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from telhado.session import fresh_path, materialise

from .common import Apart, arrow_map, split_words
from .files import mapped, write_stream

END_ID = 0
MEMO = 1_500_000
MEMO_CHARS = 64
TAILS = 100_000
# Marks that may end a word; an apostrophe is none, as it may begin a piece with letters.
_TAIL = ".,;:!?*$%&#|)\"-"
# A space behind another character than white space begins a new piece, whatever stands before it.
_CUT = re.compile(r"(?<=\S)(?= )")
ROWS_OUT = 4000


@contextmanager
def no_collection() -> Iterator[None]:
    """The garbage collector held off: lists of new words hold no cycles, and it would walk through them again and again."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


class ByteEncoder:
    """Whole-text ids of a byte-level BPE tokenizer whose pieces begin at such spaces.

    No piece of the pre-tokenizer reaches over a space that follows another character, so the ids of
    a text are those of its stretches between such spaces. The library encodes each different
    stretch of a batch once; a bounded memo keeps them for later batches.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.apart = Apart(self.tokenizer)
        self.memo: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.end = np.array([END_ID], self.dtype).tobytes()

    def _encode(self, stretches: list[str]) -> list[bytes]:
        return self.apart.encode(stretches, self.dtype)

    def _behind_space(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word with a space before it.

        Between a letter or digit and a punctuation mark pieces always part, so a word with marks at
        its end is its core and its marks.
        """
        raw = list(map(self.memo.get, words))
        new = [i for i, r in enumerate(raw) if r is None]
        if not new:
            return raw
        if len(self.memo) + 2 * len(new) > MEMO:
            self.memo.clear()
        split: list[tuple[str, str]] = []
        for i in new:
            core = words[i].rstrip(_TAIL)
            split.append((core, words[i][len(core) :]) if core and core[-1].isalnum() else (words[i], ""))
        for table, wanted, space in (
            (self.memo, {core for core, _ in split if core not in self.memo}, " "),
            (self.tails, {tail for _, tail in split if tail and tail not in self.tails}, ""),
        ):
            order = list(wanted)
            table.update(zip(order, self._encode([space + x for x in order])))
        for i, (core, tail) in zip(new, split):
            raw[i] = self.memo[core]
            if tail:
                raw[i] += self.tails[tail]
                if len(words[i]) <= MEMO_CHARS:
                    self.memo[words[i]] = raw[i]
        if len(self.tails) > TAILS:
            self.tails.clear()
        return raw

    def encode(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each with the end id; how many each has)."""
        codes, offsets, words = split_words(array)
        heads, lasts = offsets[:-1], offsets[1:] - 1
        # A space behind white space does not part pieces: such a text is cut elsewhere.
        odd = np.array([not w or w[-1].isspace() for w in words], np.bool_)[codes]
        odd[lasts] = False
        first = np.array([not words[c] for c in codes[heads]], np.bool_)
        odd[heads[first]] = False
        crossed = np.add.reduceat(odd.astype(np.int64), heads) > 0 if len(heads) else np.empty(0, np.bool_)
        own: list[bytes] = self._encode([words[c] for c in codes[heads]])
        for d in np.flatnonzero(crossed):
            own[d] = b"".join(self._encode(_CUT.split(array[int(d)].as_py())))
        packed = [*self._behind_space(words), *own, self.end]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(packed), self.dtype)
        # Each text as numbers of packed stretches: its own first word, the other words, the end.
        codes[heads] = len(words) + np.arange(len(own))
        size_of = np.repeat(crossed, np.diff(offsets))
        size_of[heads] = False
        lengths = np.where(size_of, 0, sizes[codes])
        codes = np.insert(codes, offsets[1:], len(packed) - 1)
        lengths = np.insert(lengths, offsets[1:], 1)
        ends = np.cumsum(lengths)
        place = np.repeat(starts[codes] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        bounds = offsets[1:] + np.arange(1, len(offsets))
        return flat[place], np.diff(np.concatenate(([0], ends[bounds - 1])))


def _held_encoder(held) -> ByteEncoder:
    """The encoder of this Python worker, kept between tasks in the broadcast holder."""
    store = held.value
    if "encoder" not in store:
        store["encoder"] = ByteEncoder(store["definition"])
    return store["encoder"]


def write(docs: DataFrame, definition: str, folder: str | None = None) -> DataFrame:
    """Write the token files of all `docs` (doc_id, text) to `folder`; returns the manifest.

    The manifest has a row per partition: part, name (path without ending), width (bytes of an id),
    documents, nulls (those without an id), tokens, base (ids in all earlier partitions). Documents are in
    ascending order of doc_id, null ids first, equal ids by a hash of their text, so that an id of many
    texts is cut into several partitions; rows alike in both stay together. A null text is an empty
    document; without documents there is no file and the manifest is empty. A task that is run again
    writes under another name, and the manifest names the files of the run that counted.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    held = spark.sparkContext.broadcast({"definition": definition})

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        encoder = _held_encoder(held)
        width, position, count, nulls = encoder.dtype.itemsize, 0, 0, 0
        with write_stream(f"{name}.bin") as ids, write_stream(f"{name}.idx") as index, write_stream(f"{name}.ids") as own:
            for batch in columns:
                if not len(batch["text"]):
                    continue
                with no_collection():
                    found, sizes = encoder.encode(batch["text"])
                ids.write(found.tobytes())
                index.write((position + np.cumsum(sizes) - sizes).astype("<u8").tobytes())
                own.write(batch["doc_id"].fill_null(0).to_numpy().astype("<i8").tobytes())
                nulls += batch["doc_id"].null_count
                position += len(found)
                count += len(sizes)
            index.write(np.array([position], "<u8").tobytes())
        if count:
            yield {
                "part": pa.array([part], pa.int32()),
                "name": pa.array([name]),
                "width": pa.array([width], pa.int32()),
                "documents": pa.array([count], pa.int64()),
                "nulls": pa.array([nulls], pa.int64()),
                "tokens": pa.array([position], pa.int64()),
            }

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).repartitionByRange("doc_id", "key")
    ordered = keyed.sortWithinPartitions("doc_id", "key", "text").select("doc_id", "text")
    parts = materialise(
        arrow_map(ordered, run, "part int, name string, width int, documents long, nulls long, tokens long"), "manifest"
    )
    # One row per partition of the files: small enough for one window.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).cast("long"))


def read(manifest: DataFrame, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files that the manifest names.

    `start` counts the ids of all documents before it, `n_tokens` includes the end id, `ids_crc32` is
    the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.
    """

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        for batch in columns:
            for name, width, nulls, base in zip(*(batch[c].to_pylist() for c in ("name", "width", "nulls", "base"))):
                ids = np.frombuffer(mapped(f"{name}.bin"), f"<u{width}")
                at = np.frombuffer(mapped(f"{name}.idx"), "<u8").astype(np.int64)
                own = np.frombuffer(mapped(f"{name}.ids"), "<i8")
                for lo in range(0, len(own), ROWS_OUT):
                    hi = min(lo + ROWS_OUT, len(own))
                    spans = list(zip(at[lo:hi].tolist(), at[lo + 1 : hi + 1].tolist()))
                    out = {
                        "doc_id": pa.array(own[lo:hi], pa.int64(), mask=np.arange(lo, hi) < nulls),
                        "start": pa.array(at[lo:hi] + base, pa.int64()),
                        "n_tokens": pa.array(at[lo + 1 : hi + 1] - at[lo:hi], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(ids[a:b].astype("<u4")) for a, b in spans], pa.int64()),
                    }
                    if keep_ids:
                        out["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in spans], pa.list_(pa.int64()))
                    yield out

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    return arrow_map(manifest.select("name", "width", "nulls", "base").repartition(tasks), run, schema)
