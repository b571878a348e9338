"""Tables whose columns have the operators' own names, and numbers too large."""

import pytest
from pyspark.sql import functions as F

from telhado.llm import bitslice, decontaminate, simhash

CLASHING = ["__fp", "__keep", "__keep_fp", "__dirty", "fp", "key", "__DIRTY_", "root"]


def clashing(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})


def test_columns_of_any_name_are_kept(spark):
    docs = clashing(spark, ["one two three four", "one two three four", "other words are these", None, ""])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]
    assert {tuple(r)[2:] for r in kept.collect()} == {tuple(range(len(CLASHING)))}
    words = " ".join(f"w{i}" for i in range(20))
    docs = clashing(spark, [f"before {words} after", "clean text here", None, ""])
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    unseen = decontaminate.keep_unseen(docs, items)
    assert unseen.columns == docs.columns
    assert {tuple(r)[2:] for r in unseen.collect()} == {tuple(range(len(CLASHING)))}
    assert sorted(r["doc_id"] for r in unseen.collect()) == [1, 2, 3]
    assert decontaminate.keep_unseen(docs, items.limit(0)).count() == 4
    assert decontaminate.keep_unseen(docs.limit(0), items).isEmpty() and simhash.keep_one(docs.limit(0)).isEmpty()


def test_scores_beyond_64_bits_are_refused(spark):
    large = spark.createDataFrame([(i, [4e15, 4e15 + i]) for i in range(101)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        bitslice.top_k(large).collect()
    fine = spark.createDataFrame([(i, [1e5, 1e5 + i]) for i in range(101)], "vec_id long, embedding array<double>")
    best = bitslice.top_k(fine).where("query_id = 0 AND rank = 1").first()
    assert (best["vec_id"], best["score"]) == (100, 102_400_000 * 102_400_000 + 102_400_000 * 102_502_400)
