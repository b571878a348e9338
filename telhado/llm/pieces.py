"""SentencePiece encoding and decoding as a shortest path.

The model is compiled into three transducers: the normaliser (characters to characters, a space
to the mark U+2581), the lexicon (characters to pieces, with the bytes of a character that has no
piece), and the grammar of pieces. Composed with a text they give a lattice whose cheapest path in
the tropical semiring is the encoding. For a unigram model a piece costs its negated score. For a
merge model pieces cost nothing, and two neighbours cost infinity unless merging their joint text
gives just these two: exactly one path is finite, and that is the encoding that merging arrives at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telhado.operators.joins import refuse_columns

from .common import arrow_map, texts

MARK = "▁"
# Memo bounds of a worker: segments of each of two generations, their characters, pairs of pieces.
MEMO = 500_000
MEMO_CHARS = 48
PAIRS = 1_000_000
PREFIX = 4
UNKNOWN_PENALTY = 10.0
UNIGRAM, MERGES = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Transducer:
    """A compiled model; encodes and decodes one text at a time."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        if norm.precompiled_charsmap or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with the identity normaliser and leading marks are compiled")
        self.kind = spec.trainer_spec.model_type
        if self.kind not in (UNIGRAM, MERGES) or any(p.type in (USER, UNUSED) for p in spec.pieces):
            raise ValueError("only unigram and merge models without user-defined or unused pieces are compiled")
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.escape = norm.escape_whitespaces
        self.lexicon = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.scores = [p.score for p in spec.pieces]
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        self.longest = max(map(len, self.lexicon), default=1)
        starts: dict[str, set[int]] = {}
        for piece in self.lexicon:
            for m in range(2, min(PREFIX, len(piece)) + 1):
                starts.setdefault(piece[:m], {1}).add(len(piece))
        for head, own in starts.items():
            own.update(m for m in range(2, len(head)) if head[:m] in self.lexicon)
        # By what a text goes on with, the lengths of the pieces it may go on with, longest first.
        self.sizes = {head: tuple(sorted(n, reverse=True)) for head, n in starts.items()}
        self.cheapest = min((self.scores[i] for i in self.lexicon.values()), default=0.0) - UNKNOWN_PENALTY
        # No piece holds a mark behind another character: every such place parts the lattice.
        self.parted = not any(MARK in p.lstrip(MARK) for p in self.lexicon)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.raw: dict[str, bytes] = {}
        self.output = [self._output(i, p) for i, p in enumerate(spec.pieces)]

    def _output(self, number: int, piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        if piece.type == UNKNOWN:
            return b" \xe2\x81\x87 "
        return b"" if piece.type == CONTROL else piece.piece.replace(MARK, " ").encode()

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        text = " " + text if self.prefix else text
        return text.replace(" ", MARK) if self.escape else text

    def _merge(self, symbols: list[str]) -> list[str]:
        """The merge rules on a short text: best score first, leftmost among equals."""
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                number = self.lexicon.get(symbols[i] + symbols[i + 1])
                if number is not None and (best is None or self.scores[number] > best):
                    best, at = self.scores[number], i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def _agree(self, left: str, right: str) -> bool:
        """Whether two pieces may be neighbours in a merge model: no merge reaches over their border."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self._whole(right) and self._apart(left, right)
        return known

    def _apart(self, left: str, right: str) -> bool:
        symbols, border = list(left + right), len(left)
        lexicon, scores = self.lexicon, self.scores
        while len(symbols) > 2 or border:
            best, at, start, place = None, -1, 0, 0
            for i in range(len(symbols) - 1):
                number = lexicon.get(symbols[i] + symbols[i + 1])
                if number is not None and (best is None or scores[number] > best):
                    best, at, start = scores[number], i, place
                place += len(symbols[i])
            if best is None:
                return symbols == [left, right]
            if start < border < start + len(symbols[at]) + len(symbols[at + 1]) and start + len(symbols[at]) == border:
                return False
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return False

    def _whole(self, piece: str) -> bool:
        """Whether merging the piece's own text gives the piece."""
        known = self.pairs.get(("", piece))
        if known is None:
            known = self.pairs["", piece] = self._merge(list(piece)) == [piece]
        return known

    def _merge_path(self, text: str) -> list[str]:
        """The only finite path of a merge model's lattice, searched depth first, long pieces first.

        A state (place, last piece) found to lead nowhere is not entered again.
        """
        n, at, before = len(text), 0, ""
        lexicon, sizes, pairs = self.lexicon, self.sizes, self.pairs
        one = (1,)
        labels: list[str] = []
        open_: list[tuple[Iterator[int], str]] = []
        dead: set[tuple[int, str]] = set()
        choices = iter(sizes.get(text[:4]) or sizes.get(text[:3]) or sizes.get(text[:2], one))
        while at < n:
            for size in choices:
                piece = text[at : at + size]
                if len(piece) < size or (size > 1 and piece not in lexicon):
                    continue
                known = pairs.get((before, piece))
                if known is None:
                    known = self._agree(before, piece) if before else self._whole(piece)
                if known and (at + size, piece) not in dead:
                    open_.append((choices, before))
                    labels.append(piece)
                    at += size
                    before = piece
                    choices = iter(
                        sizes.get(text[at : at + 4]) or sizes.get(text[at : at + 3]) or sizes.get(text[at : at + 2], one)
                    )
                    break
            else:
                dead.add((at, before))
                at -= len(labels.pop())
                choices, before = open_.pop()
        return labels

    def _cheapest_path(self, text: str) -> list[str]:
        """The cheapest path of a unigram model's lattice; a character without a piece is its own label."""
        n, lexicon = len(text), self.lexicon
        last, cost = [""] * (n + 1), [0.0] + [float("inf")] * n
        for end in range(1, n + 1):
            for size in range(1, min(end, self.longest) + 1):
                piece = text[end - size : end]
                number = lexicon.get(piece)
                if number is None and size > 1:
                    continue
                price = cost[end - size] - (self.cheapest if number is None else self.scores[number])
                if price < cost[end]:
                    cost[end], last[end] = price, piece
        labels = []
        at = n
        while at:
            labels.append(last[at])
            at -= len(last[at])
        return labels[::-1]

    def _raw(self, label: str) -> bytes:
        """The label's ids as little-endian unsigned 32-bit integers."""
        number = self.lexicon.get(label)
        if number is not None:
            ids = [number]
        elif self.bytes:
            ids = [self.bytes[b] for b in label.encode("utf-8", "replace")]
        else:
            ids = [self.unknown]
        raw = self.raw[label] = b"".join(i.to_bytes(4, "little") for i in ids)
        return raw

    def _segment(self, segment: str) -> bytes:
        known = self.older.get(segment)
        if known is None:
            labels = self._merge_path(segment) if self.kind == MERGES else self._cheapest_path(segment)
            raw = self.raw
            known = b"".join([raw.get(x) or self._raw(x) for x in labels])
        if len(segment) <= MEMO_CHARS:
            if len(self.memo) >= MEMO:
                self.older, self.memo = self.memo, {}
            self.memo[segment] = known
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
        return known

    def _segments(self, text: str) -> list[str]:
        """The text cut at the places that part the lattice."""
        if not text or not self.parted:
            return [text] if text else []
        if text[0] == MARK and MARK * 2 not in text:
            return [MARK + x for x in text[1:].split(MARK)]
        out, start = [], 0
        at = text.find(MARK, 1)
        while at != -1:
            if text[at - 1] != MARK:
                out.append(text[start:at])
                start = at
            at = text.find(MARK, at + 1)
        return [*out, text[start:]]

    def encode(self, text: str) -> np.ndarray:
        get, make = self.memo.get, self._segment
        return np.frombuffer(b"".join([get(s) or make(s) for s in self._segments(self.normalise(text))]), "<u4")

    def decode(self, ids: list[int]) -> str:
        output = self.output
        text = b"".join([output[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, ids) of every row from its whole text; null counts as empty and has no ids. Repeated rows stay repeated."""
    held = _shared(docs.sparkSession, model)

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        transducer = _compiled(held)
        for batch in columns:
            rows = [transducer.encode(t) for t in texts(batch["text"])]
            yield {"doc_id": batch["doc_id"], "ids": lists(rows)}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) of every row of (doc_id, ids); null ids give an empty text."""
    held = _shared(encoded.sparkSession, model)

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        transducer = _compiled(held)
        for batch in columns:
            found = [transducer.decode(ids or []) for ids in batch["ids"].to_pylist()]
            yield {"doc_id": batch["doc_id"], "text": pa.array(found, pa.string())}

    return arrow_map(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, n_chars, same) of every row: encoded and decoded again in one pass.

    `ids_crc32` is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers, `n_chars`
    the length of the decoded text, `same` whether it is the text (null counts as empty).
    """
    held = _shared(docs.sparkSession, model)

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        transducer = _compiled(held)
        for batch in columns:
            own = texts(batch["text"])
            rows = [transducer.encode(t) for t in own]
            back = [transducer.decode(r.tolist()) for r in rows]
            yield {
                "doc_id": batch["doc_id"],
                "n_tokens": pa.array([len(r) for r in rows], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(r) for r in rows], pa.int64()),
                "n_chars": pa.array([len(t) for t in back], pa.int64()),
                "same": pa.array([a == b for a, b in zip(own, back)], pa.bool_()),
            }

    return arrow_map(
        docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_crc32 long, n_chars long, same boolean"
    )


def _shared(spark, model: bytes):
    """A broadcast holder in which each Python worker keeps its compiled model and memo between tasks."""
    return spark.sparkContext.broadcast({"model": model})


def _compiled(held) -> Transducer:
    store = held.value
    if "transducer" not in store:
        store["transducer"] = Transducer(store["model"])
    return store["transducer"]


def lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    values = np.concatenate(rows).astype(np.int32) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def add_tokens(docs: DataFrame, model: bytes) -> DataFrame:
    """`docs` with its columns and `token_ids`, the encoding of each whole text; null counts as empty."""
    held = _shared(docs.sparkSession, model)

    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        transducer = _compiled(held)
        for part in parts:
            yield pd.Series([transducer.encode(v or "").astype(np.int32) for v in part], dtype=object)

    refuse_columns(docs, {"token_ids"})
    return docs.withColumn("token_ids", F.pandas_udf(ids, "array<int>")(F.col("text")))
