"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Whether an n-gram occurs in a text is a feature; its value is the log ratio of how often toxic and
other texts hold it. A logistic regression over these values gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telhado.session import materialise

from .common import arrow_map, held_out, labelled_sample, texts, training_rows

SIZES = (3, 4, 5, 6)
BUCKET_BITS = 20
# Bounds of the fit: labelled rows of each class, and n-gram buckets that get a weight.
ROWS_PER_CLASS = 4000
FEATURES = 6000
SMOOTHING = 1.0
BLOCK = 1 << 20
THRESHOLD = 0.5


@dataclass
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def _codes(text: str) -> np.ndarray:
    """Code points of the text in lower case, white space as one kind, with a space at either end."""
    raw = f" {text.lower()} ".encode("utf-32-le", "replace")
    codes = np.frombuffer(raw, np.uint32).copy()
    codes[codes < 33] = 32
    return codes


def _buckets(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of all n-grams of the text, in blocks."""
    codes = _codes(text)
    widest = max(SIZES)
    for at in range(0, len(codes), BLOCK):
        part = codes[at : at + BLOCK + widest - 1]
        state = part.copy()
        for n in range(2, widest + 1):
            state = state[: len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1 :]
            if len(state) == 0:
                break
            if n in SIZES:
                # The last block ends with the text; in others the overlap belongs to the next one.
                own = state[:BLOCK]
                mixed = (own ^ (own >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
                yield (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x297A2D39) >> np.uint32(32 - BUCKET_BITS)


class _Present:
    """Which buckets occur in a text; the table of flags is used again for each text."""

    def __init__(self) -> None:
        self.flags = np.zeros(1 << BUCKET_BITS, np.bool_)

    def of(self, text: str) -> np.ndarray:
        for b in _buckets(text):
            self.flags[b] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found


def _selector(buckets: np.ndarray) -> np.ndarray:
    """For each bucket its number among the chosen ones plus 1, or 0."""
    chosen = np.zeros(1 << BUCKET_BITS, np.int32)
    chosen[buckets] = np.arange(1, len(buckets) + 1)
    return chosen


def _chosen(selector: np.ndarray, text: str) -> np.ndarray:
    """Numbers of the chosen buckets that the text holds."""
    parts = []
    for b in _buckets(text):
        hit = selector[b]
        parts.append(hit[hit > 0])
    return np.unique(np.concatenate(parts)) - 1 if parts else np.empty(0, np.int64)


def _counts(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    """Of the task's rows: in how many of each class a bucket occurs."""
    totals = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    present = _Present()
    for batch in columns:
        for text, label in zip(texts(batch["text"]), batch["label"].to_pylist()):
            totals[label, present.of(text)] += 1
    held = np.flatnonzero(totals.sum(0))
    for part in np.array_split(held, max(1, len(held) // 50_000)):
        yield {
            "bucket": pa.array(part, pa.int32()),
            "clean": pa.array(totals[0, part], pa.int64()),
            "toxic": pa.array(totals[1, part], pa.int64()),
        }


def _features(buckets: np.ndarray):
    selector_of = buckets

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        selector = _selector(selector_of)
        for batch in columns:
            rows = [_chosen(selector, t).tolist() for t in texts(batch["text"])]
            yield {"label": batch["label"], "features": pa.array(rows, pa.list_(pa.int32()))}

    return run


def logistic(rows: list[np.ndarray], labels: np.ndarray, values: np.ndarray, l2: float, steps: int = 400):
    """Weights and bias of a logistic regression over presence features with the given values (accelerated gradient).

    Both classes weigh alike, however many rows each has.
    """
    weight = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    sizes = np.array([len(r) for r in rows])
    columns = np.concatenate(rows).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    scaled = values[columns]
    weights, bias = np.zeros(len(values)), 0.0
    ahead, ahead_bias = weights.copy(), 0.0
    per_row = np.bincount(owner, scaled**2, len(rows)) + 1
    rate = 1.0 / (0.25 * per_row.mean() + l2) if len(rows) else 0.0
    for step in range(1, steps + 1):
        margin = np.bincount(owner, scaled * ahead[columns], len(rows)) + ahead_bias
        error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels) * weight
        gradient = np.bincount(columns, scaled * error[owner], len(values)) + l2 * ahead
        new, new_bias = ahead - rate * gradient, ahead_bias - rate * error.sum()
        momentum = (step - 1) / (step + 2)
        ahead, ahead_bias = new + momentum * (new - weights), new_bias + momentum * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, bias


def fit(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, features: int = FEATURES, l2: float = 1e-4
) -> Model:
    """Fit on at most `rows_per_class` labelled documents of each class outside the held-out fold.

    Tasks count the n-grams of those documents; what reaches the driver is the `features` buckets
    that tell the classes apart best, and for each sampled document which of these it holds.
    Without labels of both classes the score is the share of the one class, or 0.
    """
    sample = materialise(labelled_sample(labels.select("doc_id", "toxic"), "toxic", rows_per_class), "sample")
    # Two classes of at most rows_per_class ids.
    train = training_rows(docs, sample)
    sizes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(np.empty(0, np.int64), np.empty(0), 40.0 if 1 in sizes else -40.0)
    clean, toxic = sizes[0], sizes[1]
    counts = (
        arrow_map(train, _counts, "bucket int, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    p, q = (F.col("toxic") + SMOOTHING) / (toxic + 2 * SMOOTHING), (F.col("clean") + SMOOTHING) / (clean + 2 * SMOOTHING)
    middle = (F.col("toxic") + F.col("clean") + 2 * SMOOTHING) / (toxic + clean + 4 * SMOOTHING)

    def gain(share, rows):
        return rows * (share * F.log(share / middle) + (1 - share) * F.log((1 - share) / (1 - middle)))

    best = (
        counts.select("bucket", F.log(p / q).alias("ratio"), (gain(p, toxic) + gain(q, clean)).alias("gain"))
        .orderBy(F.desc("gain"), "bucket")
        .limit(features)
        .collect()
    )
    buckets = np.array([r["bucket"] for r in best], np.int64)
    ratios = np.array([r["ratio"] for r in best])
    rows = arrow_map(train, _features(buckets), "label int, features array<int>").collect()
    weights, bias = logistic(
        [np.array(r["features"], np.int64) for r in rows], np.array([r["label"] for r in rows]), ratios, l2
    )
    return Model(buckets, weights * ratios, float(bias))


def _scores(model: Model):
    buckets, weights, bias = model.buckets, model.weights, model.bias

    def run(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
        selector = _selector(buckets)
        for batch in columns:
            margins = np.array([weights[_chosen(selector, t)].sum() + bias for t in texts(batch["text"])])
            score = 1 / (1 + np.exp(-np.clip(margins, -40, 40)))
            yield {"doc_id": batch["doc_id"], "score": pa.array(score, pa.float64())}

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row from its whole text; null and empty texts get the model's score of no text."""
    return arrow_map(docs.select("doc_id", "text"), _scores(model), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`; repeated rows stay repeated."""
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier does not call toxic, with all their columns."""
    model = fit(docs, labels)
    buckets, weights, bias = model.buckets, model.weights, model.bias

    def toxic(values: pd.Series) -> pd.Series:
        selector = _selector(buckets)
        margins = np.array([weights[_chosen(selector, v or "")].sum() + bias for v in values])
        return pd.Series(1 / (1 + np.exp(-np.clip(margins, -40, 40))))

    return docs.where(F.pandas_udf(toxic, "double")(F.col("text")) < threshold)
