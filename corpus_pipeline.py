"""Documents to training sequences: toxicity, language, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, in their own columns; the last returns the
pieces of packed sequences. The classifiers learn from the stage's own documents and from the labels of ``sf_dir``, in
their training folds. A stage's result is written before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stocktide.llm import jaccard, langid, packing, substrings, toxicity
from stocktide.llm.queries import table, tokenizer_file
from stocktide.llm.store import kept, release, workers_see_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_see_package(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_see_package(spark)
    return langid.accepted(docs, langid.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more."""
    workers_see_package(spark)
    return jaccard.one_of_each_group(docs, 5, 80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_see_package(spark)
    return substrings.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_see_package(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_languages),
    ("ngram_jaccard", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: The classifiers can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
