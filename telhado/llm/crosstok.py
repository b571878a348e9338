"""Alignment of two tokenizers by byte offsets, with id pairs counted in inverted bitmaps.

Every text is encoded by a byte-level tokenizer (A, from a space and the text) and by a piece model
(B, which puts that space itself). Byte offsets at which tokens of both end part them into groups;
each token of A in a group is linked to each token of B in it.

Documents are numbered (block, position). For each id pair and block a bitmap tells which documents
hold the pair linked, and how often: plane k has the documents whose number of links has bit k set,
compressed to a list of 16-bit positions or to plain bits, whichever is shorter. The union of a
pair's planes is its document bitmap; blocks share no document, so the population counts of the
unions add up to the pair's document count. The postings then carry the counts back to the documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from telhado.operators.joins import SIZE_MARGIN, broadcast_limit, planned_bytes
from telhado.session import materialise

from .common import Apart, arrow_map, split_words

MARK = "▁"
# Ids and positions of a packed link take 16 bits each.
MOST_IDS = BLOCK_DOCS = 1 << 16
# Links of a block of documents, words of a batch that are aligned at once, words kept between batches.
BLOCK_LINKS = 6_000_000
WORDS_AT_ONCE = 400_000
MEMO = 600_000
MEMO_CHARS = 48
# Groups with more links are counted by different ids in place of one by one.
LARGE_GROUP = 4096
ROWS_OUT = 50_000
# A stretch begins with a space or line feed behind another character than white space.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")

_INDEX = (
    "block long, position int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, plane int, n int, docs int, bits binary"
)


def _byte_of_character() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


class _Column:
    """An array that grows at its end."""

    def __init__(self, dtype) -> None:
        self.data, self.size = np.empty(1024, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            grown = np.empty(max(need, 2 * len(self.data)), self.data.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : need] = values
        self.size = need


class Aligner:
    """Groups and links of texts, put together from those of their words.

    No token of A or B reaches over a space or line feed that follows another character than white
    space, and nothing on one side of such a place decides the tokens on the other, so both
    encodings part there. Each different word is encoded and aligned once; a bounded memo keeps it.
    """

    def __init__(self, definition: str, model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        from tokenizers import Tokenizer

        first = json.loads(definition)
        before = first.get("pre_tokenizer") or {}
        if first.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("the first tokenizer must be byte-level, without a normaliser or a prefix of its own")
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        pieces = [p.piece for p in spec.pieces]
        own = [p.piece for p in spec.pieces if p.type in (1, 4)]
        if (
            norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix
            or any(p.type == 4 for p in spec.pieces)
            or any(MARK in p.lstrip(MARK) or "\n" in p for p in own)
        ):
            raise ValueError("the second must keep white space, put a space first, and have no piece over a border of words")
        # One reads special strings as such, to keep stretches apart; the other takes them as plain text.
        self.apart = Apart(Tokenizer.from_str(definition))
        self.plain = Tokenizer.from_str(definition)
        self.plain.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        vocabulary = self.plain.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values(), default=-1) + 1
        if max(size, len(pieces)) > MOST_IDS:
            raise ValueError(f"a vocabulary has more than {MOST_IDS} ids")
        byte_of = _byte_of_character()
        self.bytes_a = [b""] * size
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.bytes_b = [
            bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(MARK, " ").encode() for p in spec.pieces
        ]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.names = [str(i) for i in range(max(size, len(pieces)))]
        self.mark = self.pieces.piece_to_id(MARK)
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.texts: list[str] = []
        # Per word: tokens of A and B, groups, links (-1: the bytes differ), first pair and number of pairs.
        self.stats = [_Column(np.int64) for _ in range(6)]
        self.codes, self.times = _Column(np.uint64), _Column(np.int64)

    def _keep_first(self, words: int) -> None:
        """Forget the words behind the first ones."""
        pairs = int(self.stats[4].data[words]) if words < self.stats[4].size else self.codes.size
        del self.texts[words:]
        for column in self.stats:
            column.size = words
        self.codes.size = self.times.size = pairs

    def _ids_a(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all stretches, how many each has)."""
        # The mark between stretches is a special string: one that may hold it is encoded alone.
        risky = [i for i, s in enumerate(stretches) if not self.apart.mark or self.apart.risky in s]
        packed = dict(zip(risky, self.plain.encode_batch_fast([stretches[i] for i in risky], add_special_tokens=False)))
        rest = [s for i, s in enumerate(stretches) if i not in packed] if risky else stretches
        found = self.apart.encode(rest, np.uint16) if rest else []
        if risky:
            others = iter(found)
            found = [np.array(packed[i].ids, np.uint16).tobytes() if i in packed else next(others) for i in range(len(stretches))]
        return np.frombuffer(b"".join(found), np.uint16).astype(np.int64), np.fromiter(map(len, found), np.int64, len(found)) // 2

    def _ids_b(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The model puts a space first: it stands for the stretch's own, or is taken away again before a line feed.
        found = self.pieces.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
        for i, s in enumerate(stretches):
            if s == " ":
                found[i] = [self.mark]
            elif s[0] == "\n":
                del found[i][0]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())), sizes

    def _spelt(self, stretches: list[str], bytes_of: list[bytes], len_of: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the ids of each stretch spell it."""
        whole = "".join(stretches).encode()
        lengths = pc.binary_length(pa.array(stretches, pa.large_string())).to_numpy()
        own = np.concatenate(([0], np.cumsum(len_of[ids])))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        same = own[bounds[1:]] - own[bounds[:-1]] == lengths
        spelt = b"".join([bytes_of[i] for i in ids.tolist()])
        if not same.all() or spelt != whole:
            at = np.concatenate(([0], np.cumsum(lengths))).tolist()
            own = own[bounds].tolist()
            same = np.array([spelt[own[k] : own[k + 1]] == whole[at[k] : at[k + 1]] for k in range(len(stretches))], np.bool_)
        return same

    def _add(self, words: list[str]) -> None:
        """Align new words; their numbers go on from the last one's."""
        stretches = [w if w[0] in " \n" else " " + w for w in words]
        (flat_a, n_a), (flat_b, n_b) = self._ids_a(stretches), self._ids_b(stretches)
        same = self._spelt(stretches, self.bytes_a, self.len_a, flat_a, n_a)
        same &= self._spelt(stretches, self.bytes_b, self.len_b, flat_b, n_b)
        keep = np.flatnonzero(same)
        if len(keep) < len(words):
            flat_a, flat_b = flat_a[np.repeat(same, n_a)], flat_b[np.repeat(same, n_b)]
            n_a, n_b = n_a[keep], n_b[keep]
        # Laid out one after the other, the words have the same bytes in A and in B.
        ends_a, ends_b = np.cumsum(self.len_a[flat_a]), np.cumsum(self.len_b[flat_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        from_a, from_b = _starts(in_a), _starts(in_b)
        word_ends = ends_a[np.cumsum(n_a) - 1] if len(keep) else np.empty(0, np.int64)
        last_group = np.searchsorted(common, word_ends)
        n_groups = np.diff(np.concatenate(([-1], last_group)))
        word_of = np.repeat(np.arange(len(keep)), n_groups)
        links = in_a * in_b
        n_links = np.bincount(word_of, weights=links, minlength=len(keep)).astype(np.int64)

        # (word, pair, times): small groups link by link, large ones by their different ids.
        small = np.flatnonzero(links <= LARGE_GROUP)
        which = np.repeat(small, links[small])
        inside = _ranges(np.zeros(len(small), np.int64), links[small])
        code = flat_a[from_a[which] + inside // in_b[which]] << 16 | flat_b[from_b[which] + inside % in_b[which]]
        parts = [(word_of[which], code, np.ones(len(code), np.int64))]
        for g in np.flatnonzero(links > LARGE_GROUP):
            a, times_a = np.unique(flat_a[from_a[g] : from_a[g] + in_a[g]], return_counts=True)
            b, times_b = np.unique(flat_b[from_b[g] : from_b[g] + in_b[g]], return_counts=True)
            code = (a[:, None] << 16 | b).ravel()
            parts.append((np.full(len(code), word_of[g]), code, np.outer(times_a, times_b).ravel()))
        word, code, times = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((code, word))
        word, code, times = word[order], code[order], times[order]
        fresh = np.ones(len(word), np.bool_)
        fresh[1:] = (word[1:] != word[:-1]) | (code[1:] != code[:-1])
        at = np.flatnonzero(fresh)
        word, code, times = word[at], code[at], np.add.reduceat(times, at) if len(at) else times

        pairs = np.zeros(len(words), np.int64)
        pairs[keep] = np.bincount(word, minlength=len(keep))
        columns = [np.zeros(len(words), np.int64) for _ in range(3)] + [np.full(len(words), -1, np.int64)]
        for column, values in zip(columns, (n_a, n_b, n_groups, n_links)):
            column[keep] = values
        for column, values in zip(self.stats, [*columns, self.codes.size + _starts(pairs), pairs]):
            column.extend(values)
        self.codes.extend(code.astype(np.uint64))
        self.times.extend(times)

        names_a, names_b = ([self.names[i] for i in t.tolist()] for t in (flat_a, flat_b))
        groups = [
            f"{names_a[i] if m == 1 else ','.join(names_a[i : i + m])}|{names_b[j] if n == 1 else ','.join(names_b[j : j + n])}"
            for i, m, j, n in zip(from_a.tolist(), in_a.tolist(), from_b.tolist(), in_b.tolist())
        ]
        text = [""] * len(words)
        ends = (last_group + 1).tolist()
        for k, lo, hi in zip(keep.tolist(), [0, *ends], ends):
            text[k] = ";".join(groups[lo:hi])
        self.texts.extend(text)

    def _numbers(self, words: list[str]) -> tuple[np.ndarray, int]:
        """The numbers of different words, and how many words are kept once these are done with."""
        known = list(map(self.numbers.get, words))
        new = [w for w, n in zip(words, known) if n is None]
        if len(self.numbers) + len(new) > MEMO:
            self.clear()
            known, new = [None] * len(words), words
        room = MEMO - len(self.numbers)
        brief = [w for w in new if len(w) <= MEMO_CHARS]
        # What is not kept is numbered behind what is.
        rest = brief[room:] + [w for w in new if len(w) > MEMO_CHARS]
        brief = brief[:room]
        base = len(self.texts)
        if new:
            self._add(brief + rest)
        self.numbers.update(zip(brief, range(base, base + len(brief))))
        later = dict(zip(rest, range(base + len(brief), base + len(new))))
        find = self.numbers.get
        numbers = [n if n is not None else find(w, -1) for w, n in zip(words, known)]
        return np.array([later[w] if n < 0 else n for w, n in zip(words, numbers)], np.int64), base + len(brief)

    def align(self, array: pa.Array) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of texts: [tokens of A, of B, groups, links], digests of the groups, and (document, pair, times) of the links."""
        count = len(array)
        codes, offsets, words = split_words(pc.replace_substring(array, "\n", " \n"))
        heads, lasts = offsets[:-1], offsets[1:] - 1
        # A space or line feed behind white space is no place to cut: such a text is cut one place at a time.
        odd = np.array([not w or w[-1].isspace() for w in words], np.bool_)
        found = odd[codes]
        found[lasts] &= np.array([not w for w in words], np.bool_)[codes[lasts]]
        crossed = np.flatnonzero(np.add.reduceat(found.astype(np.int64), heads)) if count else np.empty(0, np.int64)
        empty = np.array([not v for v in pc.binary_length(pc.fill_null(array, "")).to_pylist()], np.bool_)
        number = {w: i for i, w in enumerate(words)}
        spans = [codes[lo:hi] for lo, hi in zip(offsets[:-1], offsets[1:])]
        for d in crossed:
            own = [s[1:] if s[0] == " " and s[1:2] not in ("", " ", "\n") else s for s in _CUT.split(" " + (array[int(d)].as_py() or ""))]
            spans[d] = np.array([number.setdefault(w, len(number)) for w in own], np.int64)
        for d in np.flatnonzero(empty):
            spans[d] = np.empty(0, np.int64)
        lengths = np.array([len(s) for s in spans], np.int64)
        codes = np.concatenate([np.empty(0, np.int64), *spans])
        used, codes = np.unique(codes, return_inverse=True)
        order = list(number)
        numbers, keep = self._numbers([order[i] for i in used.tolist()])

        doc = np.repeat(np.arange(count), lengths)
        token_words = numbers[codes]
        # What differs from its text is shorter: no two differences in one text can make up for each other.
        bad = np.zeros(count, np.bool_)
        bad[doc[self.stats[3].data[token_words] < 0]] = True
        usable = ~bad[doc]
        doc, token_words = doc[usable], token_words[usable]
        totals = []
        for column in self.stats[:4]:
            total = np.zeros(count, np.int64)
            np.add.at(total, doc, column.data[token_words])
            totals.append(total)
        texts, digests = [self.texts[i] for i in numbers.tolist()], []
        ends = np.cumsum(lengths).tolist()
        where = codes.tolist()
        for d, (lo, hi) in enumerate(zip([0, *ends], ends)):
            digests.append("" if bad[d] or lo == hi else hashlib.sha256(";".join([texts[i] for i in where[lo:hi]]).encode()).hexdigest())
        # Each different word of a document once, with how often it stands there.
        keys, repeats = np.unique(doc << 32 | token_words, return_counts=True)
        doc, token_words = keys >> 32, keys & 0xFFFFFFFF
        pairs = self.stats[5].data[token_words]
        at = _ranges(self.stats[4].data[token_words], pairs)
        links = np.repeat(doc, pairs), self.codes.data[at], self.times.data[at] * np.repeat(repeats, pairs)
        self._keep_first(keep)
        return totals, digests, *links


def _pack(position: np.ndarray, code: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Links as sortable numbers: pair, position, times; more than 16 bits of times become several numbers."""
    low = code << np.uint64(32) | position.astype(np.uint64) << np.uint64(16)
    parts = [low | np.minimum(times, 0xFFFF).astype(np.uint64)]
    while (more := np.flatnonzero(times > 0xFFFF)).size:
        low, times = low[more], times[more] - 0xFFFF
        parts.append(low | np.minimum(times, 0xFFFF).astype(np.uint64))
    return np.concatenate(parts)


def _bitmaps(pair: np.ndarray, position: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(pair, population, compressed bitmap) for each run of equal pairs; positions ascend within one."""
    starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    sizes = np.diff(np.append(starts, len(pair)))
    lengths = np.where(2 * sizes <= width, 2 * sizes, width)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    out = np.empty(offsets[-1], np.uint8)
    lists = np.flatnonzero(2 * sizes <= width)
    out[_ranges(offsets[lists], lengths[lists])] = position[_ranges(starts[lists], sizes[lists])].astype("<u2").view(np.uint8)
    dense = np.flatnonzero(2 * sizes > width)
    for lo in range(0, len(dense), 1024):
        some = dense[lo : lo + 1024]
        bits = np.zeros((len(some), width * 8), np.uint8)
        bits[np.repeat(np.arange(len(some)), sizes[some]), position[_ranges(starts[some], sizes[some])]] = 1
        out[_ranges(offsets[some], lengths[some])] = np.packbits(bits, axis=1, bitorder="little").ravel()
    return pair[starts], sizes, pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())]
    )


def _planes(packed: list[np.ndarray], documents: int) -> Iterator[dict[str, np.ndarray | pa.Array]]:
    """The planes of every pair of a block; the first of a pair has the population count of the union of all."""
    links = np.concatenate(packed)
    packed.clear()
    links.sort()
    if not len(links):
        return
    key, times = links >> np.uint64(16), (links & np.uint64(0xFFFF)).astype(np.int64)
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    key, times = key[at], np.add.reduceat(times, at)
    pair, position = (key >> np.uint64(16)).astype(np.int64), (key & np.uint64(0xFFFF)).astype(np.int64)
    del links, key
    width = -(-documents // 8)
    union, held = np.unique(pair, return_counts=True)
    told = np.zeros(len(union), np.bool_)
    for plane in range(int(times.max()).bit_length()):
        chosen = np.flatnonzero(times >> plane & 1)
        if not len(chosen):
            continue
        pairs, sizes, bits = _bitmaps(pair[chosen], position[chosen], width)
        at = np.searchsorted(union, pairs)
        docs = np.where(told[at], 0, held[at])
        told[at] = True
        yield {"pair": pairs, "plane": np.full(len(pairs), plane), "n": sizes, "docs": docs, "bits": bits}


def index(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """Documents and postings in one written table, as in `_INDEX`: a row with `a` is a plane of a pair's bitmap in a block.

    A block is filled by one task, so memory is bounded by its links and the largest document.
    """
    held = docs.sparkSession.sparkContext.broadcast({"definition": definition, "model": model})

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        store = held.value
        if "aligner" not in store:
            store["aligner"] = Aligner(store["definition"], store["model"])
        aligner = store["aligner"]
        block, position, packed, links = TaskContext.get().partitionId() << 32, 0, [], 0
        kinds = {f.name: f.type for f in _ARROW}

        def rows(count: int, **given) -> dict[str, pa.Array]:
            return {c: given[c] if c in given else pa.nulls(count, kind) for c, kind in kinds.items()}

        def postings() -> Iterator[dict[str, pa.Array]]:
            for found in _planes(packed, position):
                for lo in range(0, len(found["pair"]), ROWS_OUT):
                    part = {c: v[lo : lo + ROWS_OUT] for c, v in found.items()}
                    count, ints = len(part["pair"]), pa.int32()
                    yield rows(
                        count, block=pa.array(np.full(count, block)), a=pa.array(part["pair"] >> 16, ints),
                        b=pa.array(part["pair"] & 0xFFFF, ints), plane=pa.array(part["plane"], ints),
                        n=pa.array(part["n"], ints), docs=pa.array(part["docs"], ints), bits=part["bits"],
                    )

        for batch in columns:
            sizes = np.cumsum(pc.binary_length(pc.fill_null(batch["text"], "")).to_numpy())
            lo, whole = 0, len(sizes)
            while lo < whole:
                # About as many words at once, however long the texts are; a block's positions are bounded too.
                before = sizes[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(sizes, before + 6 * WORDS_AT_ONCE, "right")))
                hi = min(hi, whole, lo + BLOCK_DOCS - position)
                totals, digests, doc, code, times = aligner.align(batch["text"].slice(lo, hi - lo))
                count = hi - lo
                yield rows(
                    count, block=pa.array(np.full(count, block)),
                    position=pa.array(np.arange(position, position + count), pa.int32()), doc_id=batch["doc_id"].slice(lo, count),
                    **{c: pa.array(v) for c, v in zip(("n_a", "n_b", "n_groups", "n_links"), totals)},
                    groups_sha256=pa.array(digests, pa.string()),
                )
                packed.append(_pack(doc + position, code, times))
                links += len(packed[-1])
                position, lo = position + count, hi
                if links >= BLOCK_LINKS or position == BLOCK_DOCS:
                    yield from postings()
                    block, position, links = block + 1, 0, 0
        if links:
            yield from postings()

    return materialise(arrow_map(docs.select("doc_id", "text"), run, _INDEX), "aligned")


_ARROW = pa.schema(
    [("block", pa.int64()), ("position", pa.int32()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string())]
    + [(c, pa.int32()) for c in ("a", "b", "plane", "n", "docs")]
    + [("bits", pa.binary())]
)


def pair_counts(table: DataFrame) -> DataFrame:
    """(a, b, count, best) of every linked id pair: how many documents hold it linked, and whether no pair of `a` has more."""
    counts = materialise(table.where("a IS NOT NULL").groupBy("a", "b").agg(F.sum("docs").alias("count")), "pair-counts")
    # At most one row per id of the first vocabulary, so 65,536.
    most = F.broadcast(counts.groupBy("a").agg(F.max("count").alias("most")))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def _positions(n: np.ndarray, bits: pa.Array, weights: np.ndarray, into: np.ndarray) -> None:
    """Add each bitmap's weights (a column per figure) at the positions it holds."""
    lengths = pc.binary_length(bits).to_numpy().astype(np.int64)
    lists = lengths == 2 * n
    data = np.frombuffer(b"".join(bits.filter(pa.array(lists)).to_pylist()), "<u2").astype(np.int64)
    for k in range(weights.shape[1]):
        np.add.at(into[k], data, np.repeat(weights[lists, k], n[lists]))
    dense = np.flatnonzero(~lists)
    for lo in range(0, len(dense), 1024):
        some = dense[lo : lo + 1024]
        raw = np.frombuffer(b"".join(bits.take(pa.array(some)).to_pylist()), np.uint8).reshape(len(some), -1)
        full = np.unpackbits(raw, axis=1, bitorder="little")
        weight = weights[some]
        # Sums below 2^53 are exact in floating point, which is faster.
        exact = float(weight.astype(np.float64).sum()) < 2.0**53
        sums = (weight.T.astype(np.float64) @ full.astype(np.float64)).astype(np.int64) if exact else weight.T @ full.astype(np.int64)
        into[:, : full.shape[1]] += sums


def scores(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """(block, position, n_best, count_sum): what the postings return to the documents they hold."""

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        current, into = None, np.zeros((2, BLOCK_DOCS), np.int64)

        def done() -> dict[str, pa.Array]:
            at = np.flatnonzero(into[1])
            out = {"block": pa.array(np.full(len(at), current)), "position": pa.array(at, pa.int32())}
            out |= {"n_best": pa.array(into[0, at]), "count_sum": pa.array(into[1, at])}
            into[:] = 0
            return out

        for batch in columns:
            block = batch["block"].to_numpy()
            if not len(block):
                continue
            bounds = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if current != block[lo]:
                    if current is not None:
                        yield done()
                    current = int(block[lo])
                part = {c: v.slice(lo, hi - lo) for c, v in batch.items()}
                times = np.int64(1) << part["plane"].to_numpy().astype(np.int64)
                best = part["best"].to_numpy(zero_copy_only=False)
                weights = np.stack([times * best, times * part["count"].to_numpy()], axis=1)
                _positions(part["n"].to_numpy().astype(np.int64), part["bits"], weights, into)
        if current is not None:
            yield done()

    postings = table.where("a IS NOT NULL").select("block", "a", "b", "plane", "n", "bits")
    # The pairs grow with the corpus up to the product of the vocabularies: broadcast only when small.
    small = planned_bytes(pairs) * SIZE_MARGIN <= broadcast_limit(pairs)
    found = postings.join(F.broadcast(pairs) if small else pairs.hint("merge"), ["a", "b"])
    found = found.select("block", "plane", "n", "bits", "count", "best").repartition("block").sortWithinPartitions("block")
    return arrow_map(found, run, "block long, position int, n_best long, count_sum long")


def align(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of `docs`.

    `n_best` counts the links whose pair is held by as many documents as any pair of its A id,
    `count_sum` adds up the document counts of all links. A text that is null or empty, or whose tokens
    of A or B do not spell it, has no tokens: zeros and an empty digest. Repeated rows are documents of
    their own, null ids stay; other columns are not read. Very long texts are aligned whole; an empty
    table gives no rows.
    """
    table = index(docs, definition, model)
    found = scores(table, pair_counts(table))
    rows = table.where("a IS NULL").select("block", "position", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    return rows.join(found, ["block", "position"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
