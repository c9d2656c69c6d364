"""A corpus pipeline of five stages, each one operator of ``tidemark.llm`` over all that the stage before kept.

1. language_id drops documents without a letter and those whose best language has a mean byte probability of less
   than ``MIN_SCORE``, with L > 4 languages less than a ``MIN_LIFT`` of the way from 1/L (guessing) to 1.
2. line_dedup takes repeated lines out.
3. near_dedup keeps one row of each group of near-duplicates (five words, similarity 0.8), of its smallest id.
4. substring_dedup takes repeated passages of 20 words or more out; a document without any keeps its text as it is,
   of the others the kept words are joined by one space.
5. packing tokenizes the documents and packs them into sequences.

All but the last return the columns of documents, ``n_chars`` counted anew where texts change.  Null texts go in the
first stage; a document whose text becomes empty later stays, and is packed as its end id.  Rows are judged by their
own texts where they share an id or have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, lines, neardup, packing, substrings
from tidemark.llm.common import KEY, cut, on_workers, uncarried, with_key

MIN_SCORE, MIN_LIFT = 0.3, 1 / 15  #: the same with four languages


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a recognised language, each row judged by its own text."""
    on_workers(spark)
    found = langid.languages(docs, carry=True)
    guess = 1 / F.col("n_langs")
    low = F.col("score") < F.when(F.col("n_langs") > 4, guess + (1 - guess) * MIN_LIFT).otherwise(MIN_SCORE)
    gone = found.where((F.col("lang_pred") == "und") | low).select(*KEY).distinct()
    return with_key(docs).join(gone, KEY, "left_anti").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return uncarried(lines.dedup_lines(docs, carry=True), docs.columns, "text", "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduped(docs, words=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = substrings.dedup_substrings(docs, carry=True)
    out = out.withColumn("_new", F.when(F.col("n_removed") == 0, F.col("_text")).otherwise(F.col("text")))
    return uncarried(out, docs.columns, "text", "_new")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Language ID and packing are no SQL; tests/llm/test_pipeline.py compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
