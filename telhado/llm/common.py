"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telhado.session import materialise

BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Rows of whole texts are large: hand them to Python workers in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[dict[str, pa.Array]]], Iterator[dict[str, pa.Array]]], schema: str
) -> DataFrame:
    """`mapInArrow` for a function from columns to columns.

    `fn` gets an iterator of {column: array} and yields {column: array} in the order of `schema`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({name: batch.column(i) for i, name in enumerate(batch.schema.names)} for batch in batches)
        for out in fn(columns):
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return df.mapInArrow(run, schema)


def utf8(array: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    if pa.types.is_string(array.type) or pa.types.is_large_string(array.type):
        array = array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary())
    return [v or b"" for v in array.to_pylist()]


def texts(array: pa.Array) -> list[str]:
    """The texts; null is empty."""
    return [v or "" for v in array.to_pylist()]


def split_words(array: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The texts split at each space: (word numbers, where each text's begin, and their end; the different words)."""
    lists = pc.split_pattern(pc.fill_null(array, ""), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return words.indices.to_numpy().astype(np.int64), offsets - offsets[0], words.dictionary.to_pylist()


class Apart:
    """Ids of many short stretches by one call of the tokenizers library.

    The stretches are joined by a special token. The library takes special tokens out of a text
    first and encodes what lies between them each for itself, so a stretch gets the ids it gets alone.
    One that holds the token's own text, or all where the tokenizer has no such token, are encoded alone.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        plain = [
            (i, t.content)
            for i, t in sorted(tokenizer.get_added_tokens_decoder().items())
            if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)
        ]
        self.number, self.mark = plain[0] if plain else (None, "")
        self.risky = self.mark[:2]

    def encode(self, stretches: list[str], dtype: np.dtype) -> list[bytes]:
        """The ids of each stretch, packed as integers of the given kind."""
        out: list[bytes | None] = [None] * len(stretches)
        width = np.dtype(dtype).itemsize
        alone = [i for i, s in enumerate(stretches) if not self.mark or self.risky in s]
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([stretches[i] for i in alone], add_special_tokens=False)):
            out[i] = np.array(e.ids, dtype).tobytes()
        rest = [i for i, found in enumerate(out) if found is None]
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            joined = self.mark.join([stretches[i] for i in part])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
            bounds = np.flatnonzero(ids == self.number)
            if len(bounds) != len(part) - 1:
                raise RuntimeError("the tokenizer did not keep the stretches apart")
            starts, ends = [0, *((bounds + 1) * width).tolist()], [*(bounds * width).tolist(), len(ids) * width]
            raw = ids.astype(dtype).tobytes()
            for i, a, z in zip(part, starts, ends):
                out[i] = raw[a:z]
        return out


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to be none of the columns of `df`."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: Column) -> Column:
    """Rows kept away from training: crc32 of the id's text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def labelled_sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label): at most `per_class` labelled rows of each class outside the held-out fold.

    Rows are taken in the order of a hash of their id, so the sample does not depend on file
    order. An id with contradicting labels is left out.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("most"))
        .where("label = most")
        .select("doc_id", "label")
    )
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def training_rows(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(label, text) of the documents of `sample` (doc_id, label), written as a table: one row per id.

    However often an id is repeated, only its greatest text is learnt from (null only if it has no
    other), so the table has as many rows as the sample at most. The documents are read once.
    """
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return materialise(found.groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("label", "text"), "training")
