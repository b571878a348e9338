"""Quality: a linear-chain conditional random field labels every line good or bad.

A line is described by its own characters and words and by those of its neighbours. Forward and
backward messages give the probability that a line is good; the mean of these, weighted by the
length of the lines, is the document's quality.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telhado.session import materialise

from .common import arrow_map, held_out, labelled_sample, training_rows, utf8

# Bounds of the fit: labelled rows of each class, and consecutive lines of each document.
ROWS_PER_CLASS = 3000
FIT_LINES = 400
THRESHOLD = 0.3

_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _MARK, _BAR, _SHOUT, _OTHER = range(9)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[[*b"#$%&*+<=>@\\^_`{}~[]/"]] = _MARK
    kinds[[*b".,;:'\"()-?"]] = _STOP
    kinds[ord("|")], kinds[ord("!")] = _BAR, _SHOUT
    kinds[[*b" \t\n\r\x0b\x0c"]] = _SPACE
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[ord("A") : ord("Z") + 1] = _UPPER
    kinds[ord("a") : ord("z") + 1] = _LOWER
    return kinds


KINDS = _kinds()
BASE = 21


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths) of the lines of a text: a row of BASE numbers for each line. An empty text is one empty line."""
    codes = np.frombuffer(text, np.uint8)
    breaks = np.flatnonzero(codes == 10)
    starts = np.concatenate(([0], breaks + 1))
    ends = np.concatenate((breaks, [len(codes)]))
    lengths = (ends - starts).astype(np.float64)
    size = np.maximum(lengths, 1)
    kinds = KINDS[codes]
    share = np.empty((len(starts), 9))
    for k in range(9):
        total = np.concatenate(([0], np.cumsum(kinds == k, dtype=np.int64)))
        share[:, k] = (total[ends] - total[starts]) / size
    words, distinct, runs, uppers = (np.zeros(len(starts)) for _ in range(4))
    lines = text.split(b"\n")
    seen: dict[bytes, int] = {}
    repeats = np.zeros(len(starts))
    vocabulary: set[bytes] = set()
    new = np.zeros(len(starts))
    for i, line in enumerate(lines):
        own = line.split()
        words[i] = len(own)
        unlike = set(own)
        distinct[i] = len(unlike)
        runs[i] = sum(map(bytes.__eq__, own, own[1:]))
        new[i] = len(unlike - vocabulary)
        vocabulary |= unlike
        repeats[i] = line in seen and len(own) > 0
        seen[line] = i
    count = np.maximum(words, 1)
    letters = share[:, _UPPER] + share[:, _LOWER]
    shout = share[:, _UPPER] / np.maximum(letters, 1e-9)
    first = codes[np.minimum(starts, max(len(codes) - 1, 0))] if len(codes) else np.zeros(1, np.uint8)
    features = np.column_stack(
        [
            shout,
            shout > 0.5,
            share[:, _DIGIT],
            share[:, _STOP],
            share[:, _MARK],
            share[:, _MARK] > 0.05,
            share[:, _BAR],
            share[:, _BAR] > 0.02,
            share[:, _SHOUT],
            share[:, _SHOUT] > 0.02,
            share[:, _OTHER],
            np.minimum(size / count, 40) / 10,
            np.log1p(lengths) / 10,
            1 - distinct / count,
            (1 - distinct / count) > 0.6,
            runs / count,
            runs / count > 0.2,
            repeats,
            1 - new / np.maximum(distinct, 1),
            (lengths > 0) & (first >= 65) & (first <= 90),
            lengths == 0,
        ]
    ).astype(np.float64)
    return features, lengths


def with_neighbours(features: np.ndarray) -> np.ndarray:
    """A line's features, its neighbours' (0 beyond the ends) and a constant."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    return np.column_stack([features, before, after, np.ones(len(features))])


@dataclass
class Model:
    weights: np.ndarray  # of a line's features for "good"
    switch: np.ndarray  # 2 x 2, from the label of a line to that of the next; 1 is good


def _step(m, switch):
    """Log odds that the next line is good, from those of this one."""
    return np.logaddexp(switch[0, 1], m + switch[1, 1]) - np.logaddexp(switch[0, 0], m + switch[1, 0])


def _messages(evidence: np.ndarray, owner: np.ndarray, switch: np.ndarray):
    """Forward and backward log odds of each line, without its own evidence.

    All documents are advanced together, a line at a time.
    """
    n = len(evidence)
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if n else np.empty(0, np.int64)
    sizes = np.diff(np.concatenate((starts, [n])))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    forward, backward = np.zeros(n), np.zeros(n)
    deepest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(1, deepest + 1), side="right")
    for t in range(1, deepest):
        starts_t, sizes_t = starts[: alive[t]], sizes[: alive[t]]
        forward[starts_t + t] = _step(forward[starts_t + t - 1] + evidence[starts_t + t - 1], switch)
        back = starts_t + sizes_t - 1 - t
        backward[back] = _step(backward[back + 1] + evidence[back + 1], switch.T)
    return forward, backward


def marginals(evidence: np.ndarray, owner: np.ndarray, switch: np.ndarray) -> np.ndarray:
    """Probability of "good" of each line; `owner` numbers the documents, whose lines are consecutive."""
    forward, backward = _messages(evidence, owner, switch)
    return 1 / (1 + np.exp(-np.clip(forward + evidence + backward, -60, 60)))


def train(features: np.ndarray, owner: np.ndarray, labels: np.ndarray, l2: float, steps: int = 300) -> Model:
    """Weights by accelerated gradient on the conditional likelihood of the lines' labels (those of their document)."""
    n, width = features.shape
    weights, switch = np.zeros(width), np.zeros((2, 2))
    y = labels[owner].astype(np.float64)
    inner = np.concatenate((owner[1:] == owner[:-1], [False])) if n else np.empty(0, bool)
    at = np.flatnonzero(inner)
    size = np.bincount(owner)[owner]
    weight = 1.0 / size  # every document counts alike, however many lines it has
    same = np.zeros((2, 2))
    for a in (0, 1):
        same[a, a] = (weight[at] * (y[at] == a)).sum()
    first, second = (np.zeros(width), np.zeros(width)), (np.zeros((2, 2)), np.zeros((2, 2)))
    for step in range(1, steps + 1):
        evidence = features @ weights
        forward, backward = _messages(evidence, owner, switch)
        good = 1 / (1 + np.exp(-np.clip(forward + evidence + backward, -60, 60)))
        grad = features.T @ (weight * (good - y)) / len(labels) + l2 * weights
        # The joint probability of neighbouring labels from the messages on either side.
        left, right = forward[at] + evidence[at], backward[at + 1] + evidence[at + 1]
        joint = np.stack([[np.full(len(at), switch[0, 0]), switch[0, 1] + right], [switch[1, 0] + left, switch[1, 1] + left + right]])
        joint = np.exp(joint - joint.max((0, 1)))
        joint /= joint.sum((0, 1))
        grad_switch = ((joint * weight[at]).sum(2) - same) / len(labels) + l2 * switch
        for value, g, m1, m2 in ((weights, grad, first[0], first[1]), (switch, grad_switch, second[0], second[1])):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            value -= 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return Model(weights, switch)


def _stretch(features: np.ndarray, text: bytes) -> np.ndarray:
    """FIT_LINES consecutive lines, from a place that a checksum of the text chooses; all lines of a shorter text."""
    first = zlib.crc32(text) % max(1, len(features) - FIT_LINES + 1)
    return features[first : first + FIT_LINES]


def _lines(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    for batch in columns:
        found = [_stretch(line_features(t)[0], t) for t in utf8(batch["text"])]
        yield {
            "label": batch["label"],
            "lines": pa.array([len(f) for f in found], pa.int32()),
            "features": pa.array([f.astype("<f4").tobytes() for f in found], pa.binary()),
        }


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, l2: float = 1e-4) -> Model:
    """Fit on at most `rows_per_class` labelled documents of each class outside the held-out fold.

    Every line of a sampled document bears the document's label; of a longer one FIT_LINES lines in a row are learnt
    from, whose features are those they have in the whole text. A null text counts as empty, as in scoring. Only line features, of a bounded
    number of lines, reach the driver. Without labels every score is 0.5.
    """
    sample = materialise(labelled_sample(labels.select("doc_id", "quality"), "quality", rows_per_class), "sample")
    train_docs = training_rows(docs, sample)
    rows = (
        arrow_map(train_docs.select("label", "text"), _lines, "label int, lines int, features binary")
        .orderBy(F.xxhash64("features"))
        .limit(2 * rows_per_class)
        .collect()
    )
    if not rows:
        return Model(np.zeros(3 * BASE + 1), np.zeros((2, 2)))
    tables = [np.frombuffer(r["features"], "<f4").reshape(-1, BASE).astype(np.float64) for r in rows]
    features = np.concatenate([with_neighbours(t) for t in tables])
    owner = np.repeat(np.arange(len(rows)), [len(t) for t in tables])
    return train(features, owner, np.array([r["label"] for r in rows]), l2)


def qualities(values: list[bytes], model: Model) -> np.ndarray:
    """Quality of each text: the mean of its lines' marginals, weighted by length (plus 1, so that empty lines count)."""
    if not values:
        return np.empty(0)
    found = [line_features(v) for v in values]
    owner = np.repeat(np.arange(len(values)), [len(f) for f, _ in found])
    evidence = np.concatenate([with_neighbours(f) @ model.weights for f, _ in found])
    good = marginals(evidence, owner, model.switch)
    weight = np.concatenate([lengths for _, lengths in found]) + 1
    return np.bincount(owner, good * weight) / np.bincount(owner, weight)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row from its whole text; null counts as empty."""

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        for batch in columns:
            yield {"doc_id": batch["doc_id"], "score": pa.array(qualities(utf8(batch["text"]), model), pa.float64())}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`; repeated rows stay repeated."""
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` whose quality reaches the threshold, with all their columns."""
    model = fit(docs, labels)

    def quality(values: pd.Series) -> pd.Series:
        return pd.Series(qualities([v or b"" for v in values], model))

    return docs.where(F.pandas_udf(quality, "double")(F.col("text").cast("binary")) >= threshold)
