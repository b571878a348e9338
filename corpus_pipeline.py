"""A corpus pipeline: each stage filters or enriches the documents that the one before kept."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from telhado.llm import decontaminate, pieces, quality, simhash, toxicity
from telhado.llm.common import read
from telhado.llm.queries import model_bytes
from telhado.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.keep_unseen(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and their token ids."""
    return pieces.add_tokens(docs, model_bytes("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("SimHash near-dedup", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding and decoding", encode),
]

# Trained classifiers and a tokenizer are not SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
